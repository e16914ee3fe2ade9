"""Personal data: fixed patterns, plus candidates that boosted trees accept.

Everything that touches documents is column expressions: spans come from
splitting a text at a pattern and adding up the lengths of gaps and matches.
High-recall generators propose further, overlapping spans (spoken-out mail
addresses, numbers without a country code, colon-separated addresses). Each gets
format and context features; gradient-boosted trees, fitted on the driver from a
small labelled table of a few hundred rows and compiled to column expressions,
score it; a threshold calibrated on the held-out half of that table selects.

Defined results: a null or empty text has no spans; spans are code points with
an exclusive end; kinds are found independently and may overlap each other; an
added span never overlaps a base span, and of two overlapping added spans the
higher score stays (then the earlier, then the longer); texts are searched whole
and in linear time; repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

#: The base patterns. Possessive repeats and the look-behinds only keep long runs linear;
#: ``\G`` lets a match start where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: High-recall generators, one for each form that the base leaves out.
SPOKEN_MAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?+(?:@|\(at\)|\[at\]|\{at\}|at\x20)\x20?+[A-Za-z0-9-]++"
               r"(?:(?:\x20?+(?:\(dot\)|\[dot\]|\{dot\})\x20?+|\x20dot\x20|\x20?+\.)[A-Za-z0-9-]++)++")
NUMBER = r"(?<![0-9A-Za-z])\(?+[0-9]++(?:[\x20().-]{1,2}+[0-9]++){1,7}+(?![0-9A-Za-z])"
LONG_NUMBER = r"(?<![0-9A-Za-z])[0-9]{9,19}+(?![0-9A-Za-z])"
COLONS = r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}+:){5,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])"
GENERATORS = (SPOKEN_MAIL, NUMBER, LONG_NUMBER, COLONS)

BEFORE, AFTER = 32, 12  # code points of context


def _let(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def _running(lengths: Column, block: int = 256) -> Column:
    """Running sums; in blocks, so a text with very many matches doesn't cost their square."""
    def sums(xs: Column) -> Column:
        start = F.array(F.lit(0).cast("long"))
        return F.slice(F.aggregate(xs, start, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))), F.lit(2), F.greatest(F.size(xs), F.lit(1)))

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    def joined(parts: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("long")), sums(F.transform(parts, total)))
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda p, o: F.transform(sums(p), lambda v: v + o)))

    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(block)), lambda s: F.slice(lengths, s, F.lit(block)))
    return _let(cut, joined)


def matches(text: Column, pattern: str) -> Column:
    """array<struct(start, end, value)> of the leftmost non-overlapping matches."""
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))

    def placed(t: Column) -> Column:
        gaps = F.slice(t["gaps"], F.lit(1), F.size(t["hits"]))
        lengths = F.flatten(F.zip_with(gaps, t["hits"], lambda g, h: F.array(F.length(g).cast("long"), F.length(h).cast("long"))))
        return _let(_running(lengths), lambda at: F.transform(t["hits"], lambda h, i: F.struct(
            at[i * 2].alias("start"), at[i * 2 + 1].alias("end"), h.alias("value"))))

    found = _let(parts, placed)
    return F.filter(found, lambda s: s["value"].isNotNull())


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid Luhn sum."""
    def total(ds: Column) -> Column:
        worth = F.transform(F.reverse(ds), lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)))
        return F.aggregate(worth, F.lit(0), lambda a, x: a + x)

    ds = F.transform(F.regexp_extract_all(number, F.lit("[0-9]"), F.lit(0)), lambda c: c.cast("int"))
    return total(ds) % 10 == 0


def _valid_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\.", -1), lambda p: _let(F.regexp_replace(p, "^0+(?=.)", ""), lambda q: (F.length(q) <= 3) & (q.cast("int") <= 255)))


def _valid_card(value: Column) -> Column:
    return _let(digits(value), lambda d: F.length(d).between(12, 19) & luhn(d))


def base_spans(text: Column) -> list[Column]:
    """For each kind, array<struct(start, end, value)> of the base; texts without its marks are not searched."""
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,value:string>>)")
    found = ((F.contains(text, F.lit("@")), EMAIL, None),
             (text.rlike(r"[0-9]\.[0-9]"), IP, _valid_ip),
             (text.rlike(r"(?:[0-9][\x20-]?){12}"), CARD, _valid_card),
             (F.contains(text, F.lit("+")), PHONE, lambda v: F.length(digits(v)).between(9, 15)))
    def valid(spans: Column, ok) -> Column:
        return F.filter(spans, lambda s: ok(s["value"])) if ok else spans

    return [F.when(mark, valid(matches(text, p), ok)).otherwise(none) for mark, p, ok in found]


# --- candidates -----------------------------------------------------------

#: Words before a span that speak for personal data, by kind, or against it.
CUES = {"mail": r"(?i)e-?mail|mail|contact|write|reach|address", "phone": r"(?i)phone|tel\b|call|mobile|cell|fax|whatsapp|dial|contact|sms|reach",
        "card": r"(?i)card|visa|mastercard|amex|payment|iban|account", "host": r"(?i)\bip\b|ipv6|host|server|addr|client|mac",
        "other": r"(?i)order|invoice|isbn|issn|version|date|page|section|vol|doi|item|ref|track|serial|model|article|chapter|figure|table|year|score|ratio|time|build|build"}
FEATURES = ("digits", "letters", "separators", "groups", "luhn", "at", "colons", "dots", "spaces", "date", "phone_form", "known_end",
            "cue_mail", "cue_phone", "cue_card", "cue_host", "cue_other", "first_group", "last_group")
_DATE = r"^(?:(?:19|20)[0-9]{2}[ .-][0-9]{1,2}[ .-][0-9]{1,2}|[0-9]{1,2}[ .-][0-9]{1,2}[ .-](?:19|20)?[0-9]{2})$"
_PHONE_FORM = r"^\(?[0-9]{2,4}\)?[ .-]{1,2}[0-9]{3,4}[ .-][0-9]{3,4}$"
_KNOWN_END = r"(?i)(?:\.|\bdot |\(dot\)|\[dot\]|\{dot\}) ?(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu)$"


def features(value: Column, before: Column) -> Column:
    """array<double> in the order of FEATURES."""
    count = lambda p: F.regexp_count(value, F.lit(p)).cast("double")
    flag = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    group = lambda p: F.length(F.regexp_extract(value, p, 1)).cast("double")
    number = digits(value)
    return F.array(count("[0-9]"), count("[A-Za-z]"), count(r"[ ().-]"), count("[0-9]+"), flag(F.length(number).between(12, 19) & luhn(number)),
                   flag(value.rlike(r"(?i)@|[({\[]at[)}\]]| at ")), count(":"), count(r"\."), count(" "), flag(value.rlike(_DATE)),
                   flag(value.rlike(_PHONE_FORM)), flag(value.rlike(_KNOWN_END)),
                   *[flag(before.rlike(CUES[c])) for c in ("mail", "phone", "card", "host", "other")],
                   group("^[(]?([0-9]+)"), group("([0-9]+)$"))


def _kind(value: Column) -> Column:
    n = F.length(digits(value))
    return (F.when(value.rlike(r"(?i)@|[({\[]at[)}\]]|[a-z] at "), F.lit("email")).when(F.contains(value, F.lit(":")), F.lit("ip"))
            .when(n >= 12, F.lit("card")).otherwise(F.lit("phone")))


def candidates(text: Column) -> Column:
    """array<struct(start, end, value, before, kind, f)> from all generators; they may overlap."""
    marks = (text.rlike(r"(?i)@|[({\[]at[)}\]]| at "), text.rlike("[0-9][ ().-]{1,2}[0-9]"), text.rlike("[0-9]{9}"), text.rlike(r"(?:[0-9A-Fa-f]{1,4}+:){5}"))
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,value:string>>)")
    found = F.concat(*[F.when(m, matches(text, g)).otherwise(none) for m, g in zip(marks, GENERATORS)])

    def described(s: Column) -> Column:
        start = F.greatest(s["start"] - BEFORE, F.lit(0))
        before = F.substr(text, (start + 1).cast("int"), (s["start"] - start).cast("int"))
        return _let(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), before.alias("before")), lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), t["value"].alias("value"), _kind(t["value"]).alias("kind"),
            features(t["value"], t["before"]).alias("f")))

    return F.transform(found, described)


# --- boosted trees --------------------------------------------------------

Split = tuple  # (feature, cut, low, high); a leaf is a float


def labelled_table(spark: SparkSession) -> DataFrame:
    """(text, label): sentences around one candidate each, from forms and cues that are personal or not."""
    personal = [("email", "jane.doe (at) mailhost (dot) org"), ("email", "sam_k [at] example [dot] com"), ("email", "li.wei at example dot net"),
                ("email", "kontakt {at} firma {dot} de"), ("email", "a.b @ example.com"), ("phone", "555-123-4567"), ("phone", "(212) 555-0187"),
                ("phone", "020 7946 0958"), ("phone", "030.5550.1234"), ("phone", "91 555 0123"), ("phone", "0172-555-0199"), ("phone", "600 555 014"),
                ("ip", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"), ("ip", "fe80:0:0:0:204:61ff:fe9d:f156"), ("ip", "00:1b:44:11:3a:b7"),
                ("card", "4111 1111 1111 1112"), ("card", "5500-0000-0000-0005"), ("card", "378282246310006")]
    cues = {"email": ("email me: ", "write to ", "contact "), "phone": ("call ", "phone: ", "tel "), "ip": ("server ", "ip "), "card": ("card number ", "visa ")}
    other = ["2023-10-11", "11.12.2024", "3.14 15 92", "1 2 3 4 5", "12-34", "1999-2004", "10.000 20.000", "2.0.1", "978 3 16 148410 0", "1234567890123",
             "100 200 300", "7 8", "look at the dot matrix", "meet at noon dot dot", "arrive at example.Then", "stay at home.Now", "look at it dot it", "he sat at table .no", "met at noon dot Next", "was at x-y .Et", "sold @ 5.20", "1:2:3:4:5:6",
             "10 (20) 30", "4.5 - 6.7", "20231011123045", "88 99 77 66", "1.2 3.4 5.6"]
    plain = ["order ", "version ", "page ", "invoice ", "the table has ", "isbn ", "in ", "and "]
    rows = [(f"{c}{v} please", 1) for k, v in personal for c in cues[k]] + [(f"thanks, {v} works", 1) for k, v in personal if k in ("email", "ip")]
    rows += [(f"{c}{v} then", 0) for v in other for c in plain] + [(f"{c}{v} then", 0) for k, v in personal if k in ("phone", "card") for c in plain[:5]]
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(t).alias("text"), F.lit(y).alias("label")) for t, y in rows])).alias("r")).select("r.*")


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 24, depth: int = 3, rate: float = 0.3) -> tuple[float, list]:
    """Gradient-boosted trees for the log-odds: (start, trees), split by Newton gains."""
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    z, trees = np.full(len(y), start), []

    cuts = [(f, float(c), x[:, f] <= c) for f in range(x.shape[1]) for c in np.unique(x[:, f])[:-1]]

    def build(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int):
        all_g, all_h = g[rows].sum(), h[rows].sum()
        best, gain = None, 1e-6
        for f, cut, low in cuts if level else ():
            low_g, low_h = g[rows & low].sum(), h[rows & low].sum()
            won = low_g**2 / (low_h + 1) + (all_g - low_g) ** 2 / (all_h - low_h + 1) - all_g**2 / (all_h + 1)
            if won > gain + 1e-9:
                best, gain = (f, cut, low), won
        if best is None:
            return float(rate * all_g / (all_h + 1))
        f, cut, low = best
        return f, cut, build(rows & low, g, h, level - 1), build(rows & ~low, g, h, level - 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        trees.append(build(np.ones(len(y), dtype=bool), y - p, p * (1 - p), depth))
        z += [_walk(trees[-1], row) for row in x]
    return start, trees


def _walk(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def as_column(model: tuple[float, list], f: Column) -> Column:
    """The model's log-odds as a column expression over the feature array."""
    def expr(tree) -> Column:
        return F.when(f[tree[0]] <= F.lit(tree[1]), expr(tree[2])).otherwise(expr(tree[3])) if isinstance(tree, tuple) else F.lit(tree)

    out = F.lit(model[0])
    for tree in model[1]:
        out = out + expr(tree)
    return out


def fit(labelled: DataFrame, precision: float = 0.97, max_rows: int = 5_000) -> tuple[tuple[float, list], float]:
    """(model, threshold): trees from half of the labelled rows, the threshold from the other half.

    The threshold is the lowest held-out score from which on at least
    ``precision`` of the held-out candidates are personal.
    """
    rows = (labelled.select("text", "label", F.explode(candidates(F.col("text"))).alias("c")).select("text", "label", "c.start", "c.end", "c.f")
            .orderBy(F.xxhash64("text"), "start", "end").limit(max_rows).collect())
    if not rows:
        return (0.0, []), float("inf")
    x, y = np.array([r.f for r in rows]), np.array([r.label for r in rows], dtype=float)
    held = np.arange(len(y)) % 2 == 1
    model = boost(x[~held], y[~held])
    scores = np.array([model[0] + sum(_walk(t, r) for t in model[1]) for r in x[held]])
    good = [s for s in np.unique(scores) if y[held][scores >= s].mean() >= precision]
    return model, float(max(min(good), 0.0)) if good else float("inf")


def _of_kind(spans: Column, n: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end")))


def find_pii(df: DataFrame, model: tuple[tuple[float, list], float], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, counts of the base kinds, ``base_sha256``, ``spans`` and ``n_added``."""
    keep = keep if keep is not None else ["doc_id"]
    trees, threshold = model
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def added(t: Column, base: list[Column]) -> Column:
        taken = F.concat(*base)
        touches = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
        scored = F.transform(candidates(t), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
                                                               as_column(trees, c["f"]).alias("score")))
        good = F.filter(scored, lambda c: c["score"] >= F.lit(threshold))
        free = F.filter(good, lambda c: ~F.exists(taken, lambda b: touches(c, b)))

        def beaten(c: Column, d: Column) -> Column:
            first = lambda s: F.struct(s["score"], -s["start"], s["end"])
            return touches(c, d) & (first(d) > first(c))

        return _let(free, lambda fs: F.array_distinct(F.filter(fs, lambda c: ~F.exists(fs, lambda d: beaten(c, d)))))

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat(
            F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")

    def report(t: Column) -> Column:
        found = F.struct(*[c.alias(k) for k, c in zip(KINDS, base_spans(t))])

        def described(b: Column) -> Column:
            base = F.concat(*[_of_kind(b[k], n) for n, k in enumerate(KINDS, 1)])
            number = lambda c: F.array_position(F.array(*[F.lit(k) for k in KINDS]), c["kind"]).cast("int")
            more = F.transform(added(t, [b[k] for k in KINDS]), lambda c: F.struct(c["start"].alias("start"), number(c).alias("kind"), c["end"].alias("end")))
            return F.struct(*[F.size(b[k]).cast("long").alias(f"n_{k}") for k in KINDS], shown(base).alias("base"),
                            more.alias("more"), base.alias("all"))

        return _let(found, described)

    out = df.select(*[F.col(f"`{c}`") for c in keep], _let(text, report).alias("r"))
    return out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"r.n_{k}") for k in KINDS], F.sha2("r.base", 256).alias("base_sha256"),
                      shown(F.concat("r.all", "r.more")).alias("spans"), F.size("r.more").cast("long").alias("n_added"))
