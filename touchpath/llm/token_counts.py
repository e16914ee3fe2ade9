"""Token counts at every prefix of a text (byte-level BPE), by dynamic programming.

A pre-token's prefixes are solved left to right: the encoding of ``w[:i]`` ends
in the one vocabulary token ``t`` for which the encoding of ``w[:i-len(t)]``
followed by ``t`` is itself an encoding, which holds exactly when the two tokens
at the seam survive each other's merges. So each prefix costs a few lookups, and
a text keeps, for every UTF-8 byte, the change of the exact token count there.
Counts, truncation points and budget questions are then sums over that store.

Defined results: null or empty text has no bytes and no tokens; repeated rows
are counted alike; texts of any length are counted whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import accumulate

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from touchpath.llm.common import BINARY, LONG, field, map_text

#: Fixed value: the public split pattern of byte-level BPE, for texts whose characters stand for their class (see ``Classes``).
SPLIT = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

NEVER = 1 << 30
SPACES = re.compile(r"\s\s").search


class Classes(dict):
    """What a character is to the library's split: an ASCII character of its class, for ``str.translate``.

    Letters, numbers and white space differ between Unicode versions, so each
    character that isn't printable ASCII is asked of the library itself once.
    """

    def __init__(self):
        super().__init__((c, c) for c in range(32, 127))
        self.pieces = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    def __missing__(self, code: int) -> int:
        joins = (shown for beside, shown in (("a", "Z"), ("1", "0"), ("#", "#")) if len(self.pieces(beside + chr(code))) == 1)
        self[code] = found = ord(next(joins, "\t" if code != 10 else "\n"))
        return found


class Splitter:
    """Cuts texts into the library's pre-tokens."""

    def __init__(self):
        self.classes, self.find = Classes(), re.compile(SPLIT).findall

    def shapes(self, text: str) -> tuple[str, list[str], list[str]]:
        """(the text by classes, its pre-tokens by classes, its pre-tokens)."""
        shown = text.translate(self.classes)
        shapes = self.find(shown)
        if shown == text:
            return shown, shapes, shapes
        ends = list(accumulate(map(len, shapes)))
        return shown, shapes, [text[a:b] for a, b in zip([0, *ends], ends)]

    def pieces(self, text: str) -> list[str]:
        return self.shapes(text)[2]


def load_vocabulary(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Merge ranks and special strings of a ``tokenizers`` byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    chars = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    raw = lambda s: bytes(chars[c] for c in s)
    pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
    return {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}, [t["content"] for t in data["added_tokens"]]


class PrefixCounter:
    """Exact token counts of every prefix; remembers pre-tokens and token seams within one worker."""

    CACHE = 1_000_000  # entries of each memory; what comes later is computed anew each time

    def __init__(self, ranks: dict[tuple[bytes, bytes], int], specials: list[str] = ()):
        self.ranks = ranks
        tokens = [bytes([b]) for b in range(256)] + [a + b for a, b in ranks]
        ids = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
        self.tokens, self.sizes = list(ids), [len(t) for t in ids]
        self.pairs = {ids[a] << 16 | ids[b]: rank for (a, b), rank in ranks.items()}
        self.outer = self._spines(ids)
        self.ends = ahocorasick.Automaton()  # finds, for each position, the tokens that end there, longest first
        for token, i in ids.items():
            self.ends.add_word(token.decode("latin-1"), i)
        self.ends.make_automaton()
        self.split = Splitter().shapes
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.seams: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    def _spines(self, ids: dict[bytes, int]) -> tuple[list, list]:
        """Per token, its outermost parts on the left and on the right, each with the rank of the merge that swallows it."""
        made = {ids[a + b]: (ids[a], ids[b], rank) for (a, b), rank in self.ranks.items()}
        sides: tuple[list, list] = ([], [])
        for token in range(len(ids)):
            for side in (0, 1):
                spine, part, until = [], token, NEVER
                while part in made:
                    spine.append((part, until))
                    until, part = made[part][2], made[part][side]
                sides[side].append([*spine, (part, until)])
        return sides

    def merge(self, word: bytes) -> list[bytes]:
        """The byte-pair merges themselves, lowest rank first."""
        parts, rank = [word[i:i + 1] for i in range(len(word))], self.ranks.get
        while len(parts) > 1:
            order = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
            best = min(order)
            if best == NEVER:
                break
            at = order.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether token ``left`` (-1: the start) then token ``right`` is what their bytes encode to.

        It is unless a merge across the seam comes up while both of its parts
        still stand; of equal ranks the merge further left goes first.
        """
        if left < 0:
            return self.merge(self.tokens[right]) == [self.tokens[right]]
        pairs, starts = self.pairs, self.outer[0][right]
        for a, a_until in self.outer[1][left]:
            for b, b_until in starts:
                rank = pairs.get(a << 16 | b)
                if rank is not None and rank < a_until and rank <= b_until:
                    return False
        return True

    def prefixes(self, word: bytes) -> list[int]:
        """Token count of each prefix of one pre-token; entry 0 is the empty prefix."""
        last, counts, done = [-1] * (len(word) + 1), [0] * (len(word) + 1), 0
        sizes, seams = self.sizes, self.seams
        for end, token in self.ends.iter(word.decode("latin-1")):
            if end < done:
                continue  # this prefix is solved
            before = end + 1 - sizes[token]
            seam = last[before] * 65_536 + token
            good = seams.get(seam)
            if good is None:
                good = self.fits(last[before], token)
                if len(seams) < self.CACHE:
                    seams[seam] = good
            if good:
                done = end + 1
                last[done], counts[done] = token, counts[before] + 1
        return counts

    def deltas(self, piece: str) -> bytes:
        """Change of the count at each byte of a pre-token, as signed bytes."""
        known = self.cache.get(piece)
        if known is None:
            counts = self.prefixes(piece.encode())
            if piece[0] == "'" and len(piece) == 3 and piece.isascii() and piece[1:].isalpha():
                counts[2] = 2  # a cut contraction is an apostrophe and a letter
            known = bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])
            if len(self.cache) < self.CACHE:
                self.cache[piece] = known
        return known

    def plain(self, text: str) -> bytes:
        (shown, shapes, pieces), deltas = self.split(text), self.deltas
        known = list(map(self.cache.get, pieces))
        if None in known:
            known = [k if k is not None else deltas(p) for k, p in zip(known, pieces)]
        store = b"".join(known)
        if SPACES(shown):
            store = self._spaces(pieces, shapes, bytearray(store))
        return bytes(store)

    def _spaces(self, pieces: list[str], shapes: list[str], store: bytearray) -> bytes:
        """In a run of white space that the next pre-token cuts, a prefix ends in the whole run."""
        at = 0
        for piece, shape, after, next_shape in zip(pieces, shapes, [*pieces[1:], ""], [*shapes[1:], ""]):
            size = len(piece.encode())
            if shape.isspace() and next_shape and next_shape[0].isspace():
                run = piece + after[0]
                end, whole = at + len(run.encode()), self.prefixes(run.encode())
                normal = np.frombuffer(bytes(store[at:end]), np.int8).sum()
                shift = int(whole[-1] - normal)
                store[end - 1] = (store[end - 1] + shift) % 256
                if end < len(store):
                    store[end] = (store[end] - shift) % 256
                elif shift:
                    raise AssertionError("a run at the end of a text is one pre-token")
            at += size
        return bytes(store)

    def store(self, text: str) -> bytes:
        """Signed change of the token count at every byte of ``text``."""
        if self.specials is None or not (found := self.specials.search(text)):
            return self.plain(text)
        out = []
        while found:
            head, special = text[:found.start()], found.group()
            part = np.frombuffer(self.plain(head + special), np.int8).astype(np.int64)
            size = len(head.encode())
            if size:  # a run of spaces before the special string ends its own text
                part[:size] = np.frombuffer(self.plain(head), np.int8)
            inside = part[size:]
            if len(inside) > 1:
                whole = self._counts_inside(head, special, size)
                inside[:] = np.diff(whole)
            out.append(part.astype(np.int8).tobytes())
            text = text[found.end():]
            found = self.specials.search(text)
        return b"".join(out) + self.plain(text)

    def _counts_inside(self, head: str, special: str, size: int) -> list[int]:
        base = int(np.frombuffer(self.plain(head), np.int8).sum()) if head else 0
        counts = [base]
        for i in range(1, len(special)):
            n = int(np.frombuffer(self.plain(head + special[:i]), np.int8).sum())
            counts += [n] * len(special[i - 1].encode())
        return counts + [base + 1] * len(special[-1].encode())


def n_tokens(store: bytes) -> int:
    return int(np.frombuffer(store, np.int8).sum(dtype=np.int64))


def tokens_at(store: bytes, n_bytes: int) -> int:
    """Exact token count of the first ``n_bytes`` bytes (a code point boundary)."""
    return n_tokens(store[:n_bytes])


def longest_prefix(store: bytes, text: str, budget: int) -> str:
    """Longest prefix of ``text`` with at most ``budget`` tokens, without re-encoding."""
    counts = np.concatenate([[0], np.cumsum(np.frombuffer(store, np.int8), dtype=np.int64)])
    ends = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text], dtype=np.int64)]).astype(np.int64)
    fitting = np.flatnonzero(counts[ends] <= budget)
    return text[:fitting[-1]]


def token_prefixes(df: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] | None = None,
                   with_store: bool = True) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_tokens`` and, if asked for, the per-byte ``prefix_store``.

    ``vocabulary`` is the path of a ``tokenizers`` byte-level BPE file; it is
    read once on the driver and its merges (a fixed-size table) go to the tasks.
    """
    ranks, specials = load_vocabulary(vocabulary)
    shared = df.sparkSession.sparkContext.broadcast({"vocabulary": (ranks, specials)})

    def make() -> Callable[[list[str]], list[list]]:
        worker = shared.value  # lives as long as the Python worker, and so do the counter's memories
        counter = worker.get("counter") or worker.setdefault("counter", PrefixCounter(*worker["vocabulary"]))

        def compute(texts: list[str]) -> list[list]:
            stores = [counter.store(t) for t in texts]
            return [[len(s) for s in stores], [n_tokens(s) for s in stores], *([stores] if with_store else [])]

        return compute

    fields = [field("n_bytes", LONG), field("n_tokens", LONG), *([field("prefix_store", BINARY)] if with_store else [])]
    return map_text(df, text_col, keep if keep is not None else ["doc_id"], fields, make)
