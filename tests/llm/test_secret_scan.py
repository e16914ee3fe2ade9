import base64
import hashlib
import random
import re
import secrets as noise
import string
import uuid

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import edge
from touchpath.llm import secret_scan as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32])


parts = st.sampled_from(["password", "PassWD", "secret", "ſecret", "toKen", "to\u212aen", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", ": =", "abcdefgh", "1234567", "AKIA",
                         "ABCDEFGHIJKL", "0123456789abcdef0123456789abcdef", "f", "G", "\n", "é😀"])


@settings(max_examples=300, deadline=None)
@given(st.lists(parts, max_size=10).map("".join))
def test_base_spans(text):
    assert S.base_spans(text) == brute(text)


def test_operator_on_edge_rows(spark):
    out = S.scan_secrets(edge.documents(spark), keep=["doc_id", "text"]).collect()
    assert len(out) == len(edge.rows())
    for r in out:
        base = brute(r.text or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(S.show(base).encode()).hexdigest()
        assert set(S.show(base).split(",")) <= set(r.spans.split(","))
    assert S.scan_secrets(edge.documents(spark, [])).count() == 0


def test_novelty_tells_keys_from_names():
    novelty, keys, names = S.Novelty(), 0, 0
    for _ in range(50):
        key = noise.token_urlsafe(24)
        keys += bool(S.novel_spans(f"the private key is {key}x1 here", [], novelty))
    for name in ("UserRepositoryFactoryBuilder2", "application/json/text/html1", "abcdefghijklmnopqrstuvwxyz0123456789", "example.com/static/images/1", "config_settings_environment1"):
        names += bool(S.novel_spans(f"the secret is in {name} here", [], novelty))
    assert keys >= 45 and names <= 1
    assert not S.novel_spans("nothing sensitive Zx8vQ1mN0pLr7TyU2wEi", [], novelty)


def test_values_after_a_name_and_sign_in_one_run():
    novelty, value = S.Novelty(), "9fK2xQ7LmZ4rT1vW8bY3nC6pD5sG0hJa/+Xe"
    for name in ("aws_secret_access_key", "private_key", "auth", "pwd", "passphrase", "signature", "https://a.example/x?id=3&access_key", "A=B=pwd"):
        for tail in ("", "==", "\n", "== rest"):
            text = f"export {name}={value}{tail}"
            want = (text.index(value), 3, text.index(value) + len(value) + 2 * tail.startswith("="))
            assert S.novel_spans(text, S.base_spans(text), novelty) == [want]
    assert not S.novel_spans(f"export size={value}", [], novelty)
    assert not S.novel_spans("pwd=example.com/static/images/1", [], novelty)


def test_recall_by_length_and_alphabet():
    rng, novelty = random.Random(3), S.Novelty()
    prose = "The main text of a page is kept and its menus are left out, as they tell nothing about the subject that readers came for. " * 2
    pools = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": string.ascii_uppercase + "234567",
             "base64": string.ascii_letters + string.digits + "+/", "letters": string.ascii_letters}

    def draw(kind, n):
        return "".join(rng.choice(pools[kind]) for _ in range(n))

    kinds = {f"{kind} {n}": (lambda kind=kind, n=n: draw(kind, n)) for kind in pools for n in (16, 32, 64, 128, 300, 600)}
    kinds["uuid"] = lambda: str(uuid.UUID(int=rng.getrandbits(128), version=4))
    kinds["jwt"] = lambda: "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9." + ".".join(base64.urlsafe_b64encode(rng.randbytes(n)).decode().strip("=") for n in (90, 32))
    for kind, make in kinds.items():
        found = 0
        for i in range(20):
            key, (before, after) = make(), (("bearer ", ""), (prose + "the private key is ", f" and {prose}"))[i % 2]
            found += any(e - s >= 0.9 * len(key) for s, _, e in S.novel_spans(before + key + after, [], novelty))
        assert found >= (18 if len(make()) > 16 else 16), (kind, found)
    names = ("application/json/text/html", "UserRepositoryFactoryBuilder", "static/images/assets/scripts", "createElementinnerHTMLtoString",
             "your_token_here_placeholder", "getElementByIdaddEventListener", "config_settings_environment")
    assert not [x for x in names if S.novel_spans(f"{prose}the private key is {x} and {prose}", [], novelty)]


def test_redaction_keeps_rows_and_columns(spark):
    df = edge.documents(spark)
    out = S.redact_secrets(df, length_col="n_chars")
    assert out.dtypes == df.dtypes
    got, want = sorted(map(str, out.where("doc_id != 10 or doc_id is null").collect())), sorted(map(str, df.where("doc_id != 10 or doc_id is null").collect()))
    assert got == want
    changed = out.where("doc_id = 10").first()
    assert changed.text == "[SECRET]" and changed.n_chars == 8
    assert S.redact("ab token=12345678 cd", [(3, 0, 17), (9, 2, 17)]) == "ab [SECRET] cd"
