import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import edge
from touchpath.llm import alignment as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIB_A = Tokenizer.from_file(PATHS[0])
LIB_A.encode_special_tokens = True
LIB_B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
CHARS = A.byte_level()
ALIGNER = A.Aligner(*(A._read(p) for p in PATHS))

TEXTS = [None, "", " ", "a", "The quick  brown fox", "don't <|endoftext|> stop", "日本語 text", "é x", "\x00\x1c's", "<0x41> ▁under", "line\nbreak\t tab",
         "😀😀", "straße ﬁ ﬂ", "the the the " * 30, "the fox", "the fox"]


def tokens(text):
    """(ids, byte strings) by A and by B, or None where they don't join to the text."""
    data = b" " + text.encode()
    a = LIB_A.encode(" " + text, add_special_tokens=False)
    b = LIB_B.encode(text)
    a_bytes = [bytes(CHARS[c] for c in t) for t in a.tokens]
    b_bytes = [bytes([int(p[3:-1], 16)]) if LIB_B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, LIB_B.id_to_piece(b))]
    return ((a.ids, a_bytes), (b, b_bytes)) if text and b"".join(a_bytes) == data == b"".join(b_bytes) else None


def brute(texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest; offset by offset."""
    found, counts = [], Counter()
    for text in texts:
        both = tokens(text or "")
        if not both:
            found.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for x in s]).tolist(), range(len(s)))) for _, s in both]
        pairs, groups, i, j = [], [], 0, 0
        for offset in range(len(text.encode()) + 2):
            if offset in ends[0] and offset in ends[1]:
                a, b = ends[0][offset] + 1, ends[1][offset] + 1
                pairs.append((both[0][0][a - 1], both[1][0][b - 1]))
                groups.append(",".join(map(str, both[0][0][i:a])) + "|" + ",".join(map(str, both[1][0][j:b])))
                i, j = a, b
        counts.update(pairs)
        found.append((len(both[0][0]), len(both[1][0]), pairs, ";".join(groups)))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[2]), len(f[2]), sum(counts[p] == highest[p[1]] for p in f[2]), sum(counts[p] for p in f[2]),
             hashlib.sha256(f[3].encode()).hexdigest()) for f in found]


def result(df):
    rows = df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tuple(r)[1:]))


@given(st.lists(st.integers(0, 60), max_size=40, unique=True), st.lists(st.integers(0, 60), max_size=40, unique=True), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_links_of_a_plain_merge(a, b, piece):
    a, b = sorted(a), sorted(b)
    at_a, at_b = A.links(np.array(a, np.int64), np.array(b, np.int64), piece)
    both = sorted(set(a) & set(b))
    assert [a[i] for i in at_a] == both and [b[j] for j in at_b] == both


def test_diagonals_split_the_merge_evenly():
    a, b = np.arange(0, 200, 2), np.arange(0, 300, 3)
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    steps = np.arange(0, len(merged) + 1, 7)
    assert A.diagonals(a, b, steps).tolist() == [sum(side == 0 for _, side in merged[:s]) for s in steps]


@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_groups_of_any_text(texts):
    aligner = ALIGNER
    for text, got, want in zip(texts, aligner.texts(texts), brute(texts)):
        assert (got[0], got[1], got[2]) == want[:3], text
        assert (hashlib.sha256(got[3].encode()).hexdigest() if got[3] else "") == want[6]


def test_linked_bytes_end_alike_and_pairs_stay_below_the_bound():
    aligner = ALIGNER
    a, b = aligner.a.bytes, aligner.b.bytes
    for row in aligner.texts([t or "" for t in TEXTS]):
        for p in row[4]:
            x, y = a[p // len(b)], b[p % len(b)]
            assert x.endswith(y) or y.endswith(x)
    assert A.most_pairs([b"ab", b"b", b"b"], [b"b", b"ab", b"cab"]) == 9
    assert A.most_pairs(a, b) < 500_000


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_operator_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    df = A.align_tokens(edge.plain(spark, TEXTS).repartition(3), *PATHS)
    assert [tuple(r)[1:] for r in result(df)] == brute(TEXTS)


def test_edge_rows(spark):
    rows = edge.rows()
    want = sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert [tuple(r) for r in result(A.align_tokens(edge.documents(spark), *PATHS))] == want
    assert A.align_tokens(edge.documents(spark, []), *PATHS).count() == 0


def test_groups_text(spark):
    text = "The quick  brown fox"
    row = A.align(edge.plain(spark, [text]), *PATHS, with_groups=True).first()
    ids = [[x.split(",") for x in g.split("|")] for g in row.groups.split(";")]
    assert LIB_A.decode([int(i) for a, _ in ids for i in a]) == " " + text
    assert LIB_B.decode([int(i) for _, b in ids for i in b]) == text
