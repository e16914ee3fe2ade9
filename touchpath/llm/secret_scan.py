"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty for the rest.

Each candidate is a long run of key characters with a sensitive word shortly
before it; ``name=value`` in one run is cut at the sign, and the name is context
of the value. Its novelty is the number of bytes that it adds to the compressed
size of its surroundings, with a compressor primed by a dictionary of common
code and identifiers. Words, identifiers, paths and repeats of the surroundings
compress away; a random key does not, and is reported. As a long key, or one of a
small alphabet, costs fewer bytes a character, the bytes are also held against
those of noise of the same alphabet, length and separators in the same place;
there the dictionary goes before the surroundings, so its letters count as well.
Runs of letters alone are judged by the noise only.

Defined results: a null or empty text has no spans; spans are code points with
an exclusive end; repeated rows give repeated results; texts are scanned whole,
whatever their length.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Callable, Iterable

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import LONG, STRING, field, map_text

#: The three base patterns.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]++")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
KINDS = ("assign", "access", "hex", "novel")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}+")
INNER, PADDING = re.compile(r"[^=]++"), re.compile(r"={0,2}")
SENSITIVE = re.compile(r"password|passwd|passphrase|pwd|secret|token|api.?key|access.?key|private.?key|credential|auth|bearer|signature", re.I | re.A)
#: What every match of ASSIGN, and of SENSITIVE, holds in lower case: texts without them are not searched.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE_WORDS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "signature")

BEFORE, AROUND = 48, 256  # code points searched for a sensitive word, and taken as surroundings
NOISE, NOISE_WORDS = 0.88, 0.95  # share of the bytes of noise: in general, and for a candidate with a part that looks like words
NOVELTY = 0.95  # compressed bytes a byte of the candidate; names made of known words have less, noise 1.0 and more

#: What the compressor knows beforehand.
IDENTIFIERS = """import from return class def function public private static final void const let var string integer boolean
password passwd secret token api_key apikey access_key private_key credential authorization bearer signature username email
config settings environment production development localhost database connection session request response header content-type
application/json text/html utf-8 http:// https:// www. .com/ .org/ .net/ example.com index.html static/images/assets/scripts
getElementById addEventListener createElement innerHTML toString valueOf hasOwnProperty prototype constructor undefined null
self.assertEqual __init__ __main__ True False None lambda yield async await try except finally raise with open read write close
SELECT FROM WHERE GROUP ORDER JOIN INSERT UPDATE DELETE CREATE TABLE INDEX PRIMARY FOREIGN KEY VARCHAR TIMESTAMP DEFAULT
com.example.service.impl.UserRepositoryFactoryBuilderManagerControllerHandler java.util.concurrent.atomic org.apache.commons
the of and to in is that for it with as was on be by at this are from or an have not they which you one were all their there
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef aaaaaaaaaaaaaaaa 0000000000000000 xxxxxxxxxxxx
your_token_here your-api-key changeme placeholder_value REPLACE_ME example_secret test_password dummy-credential-value""".encode()


PART = re.compile(r"[A-Za-z0-9]+")
WORDS = re.compile(r"[A-Z]{3,}|(?=[A-Za-z]{3})(?:[A-Z]?[a-z]{2,})+")
ALPHABETS = [(re.compile(f"[{chars}._=/+-]+"), pool) for chars, pool in (
    ("0-9", "0123456789"), ("0-9a-f", "0123456789abcdef"), ("0-9A-F", "0123456789ABCDEF"), ("A-Z2-7", string.ascii_uppercase + "234567"))]


def noise(value: str, seed: int) -> str:
    """``value`` with random letters and digits of its alphabet."""
    pool = next((pool for chars, pool in ALPHABETS if chars.fullmatch(value)), None)
    if pool is None or not re.search(r"[0-9]", value):
        pool = "".join(p for p in (string.ascii_lowercase, string.ascii_uppercase, string.digits) if not set(p).isdisjoint(value))
    draw = random.Random(seed)
    return "".join(draw.choice(pool) if c.isalnum() else c for c in value)


class Novelty:
    """Marginal compressed size against surroundings, with the identifiers as dictionary."""

    def __init__(self):
        words = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=19, dict_data=words, write_content_size=False, write_checksum=False)
        self.plain = zstandard.ZstdCompressor(level=19, write_content_size=False, write_checksum=False)

    def __call__(self, candidate: str, before: str, after: str) -> float:
        around = (before + "\n" + after).encode("utf-8", "surrogatepass")
        size = lambda data: len(self.compressor.compress(data))
        return (size(around + b"\n" + candidate.encode()) - size(around)) / len(candidate)

    def to_noise(self, candidate: str, before: str, after: str) -> float:
        """Bytes that the candidate adds, as a share of what noise in its place does."""
        around = IDENTIFIERS + b"\n" + (before + "\n" + after).encode("utf-8", "surrogatepass") + b"\n"
        size = lambda value: len(self.plain.compress(around + value.encode()))
        base = size("")
        return (size(candidate) - base) / max(sum(size(noise(candidate, seed)) - base for seed in range(3)) / 3, 1)

    def is_key(self, candidate: str, before: str, after: str) -> bool:
        if re.search(r"[0-9]", candidate) and self(candidate, before, after) >= NOVELTY:
            return True
        words = any(WORDS.fullmatch(part) for part in PART.findall(candidate))
        return self.to_noise(candidate, before, after) >= (NOISE_WORDS if words else NOISE)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns; failing matches are dropped, not retried."""
    low = text.lower()
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _candidates(text: str) -> Iterable[tuple[int, int]]:
    """Spans of long runs of key characters, cut after each ``=`` that isn't padding."""
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        inner = len(text[start:end].rstrip("="))
        for piece in INNER.finditer(text, start, start + inner):
            yield piece.start(), end if piece.end() == start + inner else piece.end()


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Candidates in a sensitive context that don't compress; none that touches a base span."""
    found = []
    low = text.lower()
    if not any(w in low for w in SENSITIVE_WORDS):
        return found
    covered = sorted((s, e) for s, _, e in base)
    at = reach = 0
    for start, end in _candidates(text):
        while at < len(covered) and covered[at][0] < end:
            reach = max(reach, covered[at][1])
            at += 1
        if reach > start or not SENSITIVE.search(text, max(0, start - BEFORE), start):
            continue
        value = text[start:end].strip(".=-")
        if len(value) < 16 or not re.search(r"[A-Za-z]", value):
            continue
        if novelty.is_key(value, text[max(0, start - AROUND):start], text[end:end + AROUND]):
            start = text.index(value, start)
            found.append((start, 3, start + len(value) + len(PADDING.match(text, start + len(value), end).group())))
    return found


def show(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each covered stretch replaced by ``mark``."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end = spans[i][0], spans[i][2]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], mark]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def scan_secrets(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, counts of the base kinds and of ``novel``, ``base_sha256`` and ``spans``."""

    def make() -> Callable[[list[str]], list[list]]:
        novelty = Novelty()

        def compute(texts: list[str]) -> list[list]:
            columns: list[list] = [[] for _ in range(6)]
            for text in texts:
                base = base_spans(text)
                more = novel_spans(text, base, novelty)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                sha = hashlib.sha256(show(base).encode()).hexdigest()
                for column, value in zip(columns, [*counts, sha, show(sorted(base + more)), len(more)]):
                    column.append(value)
            return columns

        return compute

    fields = [field("n_assign", LONG), field("n_access", LONG), field("n_hex", LONG), field("base_sha256", STRING),
              field("spans", STRING), field("n_novel", LONG)]
    return map_text(df, text_col, keep if keep is not None else ["doc_id"], fields, make)


def redact_secrets(df: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``df`` with every secret of ``text_col`` replaced; its columns and rows stay, null texts stay null.

    ``length_col``, if given, becomes the code points of the new text where the text changed.
    """

    def make() -> Callable[[list[str]], list[list]]:
        novelty = Novelty()

        def compute(texts: list[str]) -> list[list]:
            out = []
            for text in texts:
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base, novelty))
                out.append(redact(text, spans) if spans else None)  # null: nothing to replace
            return [out]

        return compute

    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    found = map_text(df.select(row, F.col(f"`{text_col}`")), text_col, ["__row"], [field("__redacted", STRING)], make)
    old = lambda c: F.col(f"__row.`{c}`")
    new = {text_col: F.coalesce("__redacted", old(text_col)).alias(text_col)}
    if length_col in df.columns:
        kind = df.schema[length_col].dataType
        new[length_col] = F.when(F.col("__redacted").isNull(), old(length_col)).otherwise(F.length("__redacted").cast(kind)).alias(length_col)
    return found.select(*[new.get(c, old(c)) for c in df.columns])
