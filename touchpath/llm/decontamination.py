"""Benchmark decontamination by template canonicalisation.

Words become templates: numbers, units after a number, and names turn into typed placeholders,
the rest is lower-cased (A-Z) without outer punctuation. Windows of template words of
the benchmark meet the documents' windows by hash. Hits of one item that lie on
one diagonal of document against item are one alignment; it counts if its
windows cover enough of the item and its slots are consistent: the same value of
the item is always replaced by the same value, and different values by different
ones. So verbatim copies are found, and questions with other numbers or names.
Neighbouring diagonals are chained, as after a word put in or left out; the windows
over such a seam count as held. A run of equal words of some length counts whatever
its share of the item.

A name is a capitalised word that starts no sentence and no line; windows are
taken with names as placeholders and as they are, so a changed case is met too.
A wide form takes every capitalised word for a name, also at the start of a
sentence, in capitals and beyond ASCII. Both are also taken with each run of
numbers and units, or of names, as one slot, for values of another number of
words. An alignment beyond one diagonal of the first forms must agree literally
in half of its words.

The benchmark is read in chunks of at most ``chunk_windows`` windows, each small
enough to send to every task; documents stream past each chunk, nothing is
shuffled, and no document is compared with another.

Defined results: null or empty texts and items match nothing; an item shorter
than a window is one window of its own length; windows that are mostly
placeholders don't count unless the item has no others; equal items are all
reported; repeated documents are judged alike; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import DOUBLE, LONG, field, map_text
from touchpath.llm.word_arrays import BASE, Powers, bounds, mix, range_hashes, utf8

WIDTH = 8  # template words in a window
COVER = 0.5  # share of an item's windows that an alignment must hold
AGREE = 0.8  # share of an alignment's slots that a one-to-one replacement must explain
CHUNK_WINDOWS = 1_000_000
RUN = 13  # equal words in a row that count whatever their share, if half of them are no slots
SLACK = 8  # words by which neighbouring diagonals differ at most
STRICT, WIDE, SLOTS, WIDE_SLOTS = range(4)  # numbers of the forms

#: Unit words.
UNITS = frozenset("""mm cm dm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot
feet yard yards mg g kg t lb lbs oz gram grams kilogram kilograms ounce ounces pound pounds ton tons ml cl l liter liters litre litres gallon
gallons pint pints ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years hz khz
mhz ghz v a w kw kwh j kj pa kpa n k c f °c °f degree degrees percent % $ € £ ¥ usd eur gbp dollar dollars euro euros cent cents mph kmh km/h
kb mb gb tb bit bits byte bytes""".split())
NUMBER = re.compile(r"[+-]?[$€£¥]?\d+(?:[.,:/]\d+)*(?:%|[a-z°/]{1,4})?")
_NUMBER, _UNIT, _NAME = np.uint64(1), np.uint64(2), np.uint64(3)


#: Bytes that outer punctuation doesn't hold (letters, digits, ``_$%`` and all beyond ASCII), and those that end a sentence.
CORE = np.array([b >= 128 or chr(b).isalnum() or b in b"_$%" for b in range(256)])
SENTENCE_END = np.isin(np.arange(256), list(b".!?:"))
NUMBER_START = np.isin(np.arange(256), [*b"0123456789$", 0xC2, 0xE2])  # 0xC2, 0xE2: of the other currencies
UPPER = np.isin(np.arange(256), range(65, 91))
CAPITALS = np.array([chr(c).isupper() or chr(c).istitle() for c in range(0x20000)])  # no letter with a case is beyond


def _capitals(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the UTF-8 characters at ``starts`` are capitals."""
    out = UPPER[text[starts]]
    beyond = np.flatnonzero(text[starts] >= 0xC3)
    if not len(beyond):
        return out
    first, *more = (text[np.minimum(starts[beyond] + i, len(text) - 1)].astype(np.int64) for i in range(4))
    a, b, c = (x & 63 for x in more)
    code = np.select([first < 224, first < 240], [(first & 31) << 6 | a, (first & 15) << 12 | a << 6 | b], (first & 7) << 18 | a << 12 | b << 6 | c)
    out[beyond] = CAPITALS[np.minimum(code, len(CAPITALS) - 1)]
    return out


def _stripped(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without outer punctuation; a word of nothing else keeps its last byte."""
    starts, ends = starts.copy(), ends.copy()
    for edge, offset, step in ((starts, 0, 1), (ends, -1, -1)):
        todo = np.flatnonzero(~CORE[text[edge + offset]])
        todo = todo[ends[todo] - starts[todo] > 1]
        while len(todo):
            edge[todo] += step
            todo = todo[~CORE[text[edge[todo] + offset]] & (ends[todo] - starts[todo] > 1)]
    return starts, ends


class Form(NamedTuple):
    """Codes of template words, their kinds (0 for none, 1 number, 2 unit, 3 name), and the word each starts at, with the end."""

    code: np.ndarray
    kind: np.ndarray
    at: np.ndarray


class Template:
    """Template words of a text.

    ``forms[STRICT]`` have names as they are and, if there are names, also as
    placeholders, where a name starts with one of A-Z, not followed by another;
    ``forms[WIDE]`` has every capitalised word as a name. ``forms[SLOTS]`` and
    ``forms[WIDE_SLOTS]`` are both with runs of slots as one; ``plain`` are the
    hashes of the words.
    """

    def __init__(self, text: str, powers: Powers):
        self.data = utf8(text)
        raw = np.frombuffer(self.data, np.uint8)
        starts, ends = bounds(raw)
        self.starts, self.ends = _stripped(raw, starts, ends)
        code = range_hashes(np.frombuffer(self.data.lower(), np.uint8), self.starts, self.ends, powers)
        self.kind = np.zeros(len(code), dtype=np.int64)
        self.plain = code.copy()
        at = np.arange(len(code) + 1)
        self.forms = [[Form(code, self.kind, at)]] * 4
        if not len(code):
            return
        first = raw[self.starts]
        numbers = np.array([i for i in np.flatnonzero(NUMBER_START[first]).tolist() if NUMBER.fullmatch(self.word(i))], dtype=np.int64)
        units = np.array([i for i in (numbers + 1).tolist() if i < len(code) and self.word(i) in UNITS], dtype=np.int64)
        self.kind[units], code[units] = 2, _UNIT
        self.kind[numbers], code[numbers] = 1, _NUMBER
        capital = UPPER[first]
        capital[0] = False
        names = np.flatnonzero(capital)
        second = raw[np.minimum(self.starts[names] + 1, len(raw) - 1)]
        names = names[((self.ends[names] - self.starts[names] == 1) | ~UPPER[second]) & (self.kind[names] == 0)]
        if len(names):
            lines = np.flatnonzero(raw == 10)
            same_line = np.searchsorted(lines, starts[names]) == np.searchsorted(lines, starts[names - 1])
            names = names[same_line & ~SENTENCE_END[raw[ends[names - 1] - 1]]]
        if len(names):
            self.kind[names] = 3
            typed = code.copy()
            typed[names] = _NAME
            self.forms[STRICT].append(Form(typed, self.kind, at))
        wide, kind = self.forms[STRICT][-1].code.copy(), self.kind.copy()
        capitals = (kind == 0) & _capitals(raw, self.starts)
        wide[capitals], kind[capitals] = _NAME, 3
        strict, wide = self.forms[STRICT], Form(wide, kind, at)
        ended = SENTENCE_END[raw[ends - 1]]
        self.forms = [strict, [wide], [_joined(strict[-1], ended)], [_joined(wide, ended)]]

    def word(self, i: int) -> str:
        return self.slot(i, i + 1)

    def slot(self, start: int, end: int) -> str:
        return self.data[self.starts[start]:self.ends[end - 1]].decode("utf-8", "replace").lower()


def _joined(form: Form, ended: np.ndarray) -> Form:
    """``form`` with each run of numbers and units, or of names, as one; none goes past a word that ends a sentence."""
    group = np.where(form.kind == 2, 1, form.kind)
    first = np.ones(len(group), dtype=bool)
    first[1:] = (group[1:] == 0) | (group[1:] != group[:-1]) | ended[:-1]
    if first.all():
        return form
    at = np.flatnonzero(first)
    code, kind = form.code[at], group[at]
    code[kind == 1] = _NUMBER
    return Form(code, kind, np.append(at, len(first)))


def window_hashes(code: np.ndarray, width: int) -> np.ndarray:
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = code[:n].copy()
    for i in range(1, width):
        out *= BASE
        out += code[i:i + n]
    return mix(out)


class Hit(NamedTuple):
    number: int  # of the form
    item: int  # position in the item's form
    doc: int  # in the document's
    width: int


class Benchmark:
    """Template windows of one chunk of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.powers = Powers()
        self.items, self.windows = [], defaultdict(lambda: defaultdict(list))  # (form number, width) -> hash -> (item, start)
        for item_id, text in items:
            item = Template(text, self.powers)
            if not len(item.kind):
                continue
            width = min(WIDTH, len(item.kind))
            literal = np.convolve(item.kind == 0, np.ones(width, dtype=int), "valid") * 2 >= width
            starts = np.flatnonzero(literal) if literal.any() else np.arange(len(literal))
            at = len(self.items)
            self.items.append((item_id, item, frozenset(starts.tolist())))
            for form in item.forms[STRICT]:
                self._add(at, STRICT, form, width, starts)
            for number in (WIDE, SLOTS, WIDE_SLOTS) if literal.any() else ():
                (form,) = item.forms[number]
                width = min(WIDTH, len(form.code))
                words = np.convolve(form.kind == 0, np.ones(width, dtype=int), "valid")
                self._add(at, number, form, width, np.flatnonzero(words >= 2))
        self.filters = {}
        for key, known in self.windows.items():
            seen = np.zeros(1 << 22, dtype=bool)  # most windows of a text are turned away here
            seen[[h & 0x3FFFFF for h in known]] = True
            self.filters[key] = seen

    def _add(self, item: int, number: int, form: Form, width: int, starts: np.ndarray) -> None:
        known, hashed = self.windows[number, width], window_hashes(form.code, width)
        for i in starts.tolist():
            known[int(hashed[i])].append((item, i))

    def leaks(self, text: str) -> list[tuple[int, float]]:
        """(item_id, share of its windows) of every item that the text holds."""
        doc = Template(text, self.powers)
        found: dict[int, dict[tuple[int, int], Hit]] = defaultdict(dict)  # item -> (shift, word of the item) -> hit
        hashes: dict[tuple[int, int], np.ndarray] = {}
        for (number, width), known in self.windows.items():
            for form in doc.forms[number]:
                key = id(form), width
                if key not in hashes:
                    hashes[key] = window_hashes(form.code, width)
                hashed = hashes[key]
                for j in np.flatnonzero(self.filters[number, width][(hashed & np.uint64(0x3FFFFF)).astype(np.int64)]).tolist():
                    for at, i in known.get(int(hashed[j]), ()):
                        _, item, starts = self.items[at]
                        ours, hits = item.forms[number][-1].at, found[at]
                        shift = int(form.at[j] - ours[i])
                        for word in range(ours[i], ours[i + 1]):  # all words of a slot
                            if word in starts and ((shift, word) not in hits or hits[shift, word].number > number):
                                hits[shift, word] = Hit(number, i, j, width)
        best: dict[int, float] = {}
        for at, hits in found.items():
            item_id, item, starts = self.items[at]
            for held, used, strict in self._alignments(doc, item, starts, hits):
                share = held / len(starts)
                if share > best.get(item_id, 0) and (used is None or share >= COVER and self._agree(doc, item, used, strict)):
                    best[item_id] = share
        return sorted(best.items(), key=lambda x: (x[0] is None, x[0]))

    @staticmethod
    def _alignments(doc: Template, item: Template, starts: frozenset[int],
                    hits: dict[tuple[int, int], Hit]) -> Iterable[tuple[int, list[Hit] | None, bool]]:
        """(windows held, their hits, whether on one diagonal of strict forms); no hits for a run of equal words."""
        for number in (STRICT, WIDE):
            by_shift = defaultdict(list)
            for (shift, _), hit in hits.items():
                if hit.number <= number:
                    by_shift[shift].append(hit)
            for shift, used in by_shift.items():
                yield len(used), used, number == STRICT
                if number == STRICT and _equal_run(doc, item, shift):
                    yield len(used), None, True
        for number in (STRICT, WIDE_SLOTS):
            some = {k: hit for k, hit in hits.items() if hit.number <= number}
            if len({shift for shift, _ in some}) > 1 or number != STRICT:
                yield *_chain(some, starts), False

    @staticmethod
    def _agree(doc: Template, item: Template, hits: list[Hit], strict: bool) -> bool:
        """Whether the slots of the windows are consistent and, unless ``strict``, enough of their words equal."""
        words: dict[int, tuple[int, str, str] | None] = {}
        for number, i, j, width in hits:
            ours, theirs = item.forms[number][-1], doc.forms[number][-1]
            for a, b in zip(range(i, i + width), range(j, j + width)):
                if (word := int(ours.at[a])) not in words:
                    slot = ours.kind[a] and ours.kind[a] == theirs.kind[b]
                    words[word] = (int(ours.kind[a]), item.slot(word, ours.at[a + 1]), doc.slot(theirs.at[b], theirs.at[b + 1])) if slot else None
        slots = Counter(x for x in words.values() if x)
        if not strict:
            equal = len(words) - sum(n for (_, a, b), n in slots.items() if a != b)
            if equal * 2 < len(words) or equal < WIDTH // 2:
                return False
        explained, used, taken = 0, set(), set()
        for (kind, a, b), n in sorted(slots.items(), key=lambda x: (-x[1], x[0])):
            if (kind, a) not in used and (kind, b) not in taken:
                used.add((kind, a))
                taken.add((kind, b))
                explained += n
        return explained >= AGREE * sum(slots.values())


def _equal_run(doc: Template, item: Template, shift: int) -> bool:
    """Whether a diagonal has RUN equal words in a row, half of them no slots."""
    low, high = max(0, -shift), min(len(item.plain), len(doc.plain) - shift)
    if high - low < RUN:
        return False
    equal = item.plain[low:high] == doc.plain[low + shift:high + shift]
    whole = np.convolve(equal, np.ones(RUN, dtype=int), "valid") == RUN
    return bool((whole & (np.convolve(item.kind[low:high] == 0, np.ones(RUN, dtype=int), "valid") * 2 >= RUN)).any())


def _chain(hits: dict[tuple[int, int], Hit], starts: frozenset[int]) -> tuple[int, list[Hit]]:
    """Windows held by the best chain of hits on neighbouring diagonals, in the order of item and document; and its hits."""
    runs: list[list[int]] = []  # first word, diagonal, last word
    for shift, word in sorted(hits):
        if runs and runs[-1][1] == shift and runs[-1][2] == word - 1:
            runs[-1][2] = word
        else:
            runs.append([word, shift, word])
    ends: dict[int, tuple] = {}  # diagonal -> best chain that ends there: windows held, last word, first word of its last run, the chain before
    for first, shift, last in sorted(runs):
        best = (last - first + 1, last, first, shift, None)
        for other in range(shift - SLACK, shift + SLACK + 1):
            before = ends.get(other)
            if before is None or before[1] >= last:
                continue
            start = max(first, before[1] + 1, before[1] + other - shift + 1)  # past the chain's end in both
            if start > last:
                continue
            held = before[0] + last - start + 1
            if other != shift and start - before[1] <= WIDTH + 1:
                held += sum(word in starts for word in range(before[1] + 1, start))  # windows over the seam
            best = max(best, (held, last, start, shift, before), key=lambda x: x[0])
        if shift not in ends or best[0] >= ends[shift][0]:
            ends[shift] = best
    held, used = max(ends.values(), key=lambda x: x[0]), []
    count = held[0]
    while held is not None:
        _, last, first, shift, held = held
        used += [hits[shift, word] for word in range(first, last + 1)]
    return count, used


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: list[str] | None = None,
               chunk_windows: int = CHUNK_WINDOWS) -> DataFrame:
    """``keep`` columns, ``item_ids`` (items that the text holds, ascending) and ``share`` (the largest share held).

    ``benchmark`` has item_id and text.
    """
    keep = keep if keep is not None else ["doc_id"]
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0  # no text has more windows than characters
    chunks = max(1, -(-total * 5 // (8 * chunk_windows)))  # windows are held in up to five forms, not two
    out = docs
    for chunk in range(chunks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == chunk) if chunks > 1 else items
        rows = sorted(((r.item_id, r.text) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def make(shared=shared) -> Callable[[list[str]], list[list]]:
            known = Benchmark(shared.value)

            def compute(texts: list[str]) -> list[list]:
                leaks = [known.leaks(t) for t in texts]
                return [[[i for i, _ in x] for x in leaks], [max((s for _, s in x), default=0.0) for x in leaks]]

            return compute

        name = lambda c, chunk=chunk: f"__{c}_{chunk}"
        out = map_text(out, text_col, out.columns, [field(name("ids"), T.ArrayType(LONG)), field(name("share"), DOUBLE)], make)
    ids = F.array_sort(F.flatten(F.array(*[F.col(f"__ids_{c}") for c in range(chunks)])))
    shares = [F.col(f"__share_{c}") for c in range(chunks)]
    return out.select(*[F.col(f"`{c}`") for c in keep], ids.alias("item_ids"), (F.greatest(*shares) if chunks > 1 else shares[0]).alias("share"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(f"`{text_col}`"))
    return with_leaks(inner, benchmark, text_col, ["__row"]).where("size(item_ids) = 0").select("__row.*")
