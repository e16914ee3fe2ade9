import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import edge
from touchpath.llm.token_counts import PrefixCounter, load_vocabulary, longest_prefix, n_tokens, token_prefixes, tokens_at

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = PrefixCounter(*load_vocabulary(PATH))

parts = st.sampled_from(["a", "the", " ", "  ", "\n", "'re", "'ll", "'", "12", "é", "\u00a0", "<|endoftext|>", "<|end", "!!", "   ", "日本", "\t", "😀",
                         "'s", "\x1c", "\u2028", "²", "_", "tion", " Wh"])


def count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(parts, max_size=9).map("".join) | st.text(max_size=12))
@example("\x1c's")
@example("a\x1d \x1e  b\x1f\x1f's")
@example("\u0558\u058b's \u208f1 \u0c5ca\u0cdc\u088f")
@example("\x85\x85a \u2028\u2029 \u3000\u3000b")
@example("\n\n\na\r\n b\x0b\x0cc")
def test_every_prefix_matches_the_library(text):
    store = COUNTER.store(text)
    assert len(store) == len(text.encode())
    for i in range(len(text) + 1):
        assert tokens_at(store, len(text[:i].encode())) == count(text[:i])


def test_every_code_point_is_split_as_the_library_does():
    """All of the planes that hold characters, and a part of the empty ones."""
    codes = [c for c in [*range(0x323B0), *range(0x323B0, 0x110000, 997), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c}1{c} {c}'s{c}\n{c} {c}x" for c in map(chr, codes)]
    for at in range(0, len(texts), 20_000):
        part = texts[at:at + 20_000]
        wrong = [t for t, e in zip(part, LIBRARY.encode_batch(part, add_special_tokens=False)) if n_tokens(COUNTER.store(t)) != len(e.ids)]
        assert not wrong, [hex(ord(t[1])) for t in wrong][:20]


@pytest.mark.parametrize("budget", [0, 1, 5, 10_000])
def test_longest_prefix(budget):
    text = edge.SENTENCE
    cut = longest_prefix(COUNTER.store(text), text, budget)
    assert text.startswith(cut) and count(cut) <= budget
    assert all(count(text[:i]) > budget for i in range(len(cut) + 1, len(text) + 1))


def test_operator_on_edge_rows(spark):
    out = token_prefixes(edge.documents(spark), PATH, keep=["doc_id", "text"]).collect()
    assert len(out) == len(edge.rows())
    for r in out:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), count(r.text or ""))
    assert token_prefixes(edge.documents(spark, []), PATH).count() == 0
