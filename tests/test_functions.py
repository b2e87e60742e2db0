import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import similarity, text, tokens, translit

NAMES = [
    ("P.V.T. x", "private x"), ("U.S. Bank", "u s bank"), ("U.S.A", "usa"), ("A&B Co.", "a and b company"),
    ("LLCs", "limited liability companys"), ("Co.Ltd", "companylimited"), ("Co-op", "company op"), ("Straße", "strasse"),
    ("***", "***"), ("S.A.S. X", "sas x"), ("", ""), (None, ""), ("    ", ""), ("Éa Co", "ea company"), ("éco co", "eco company"),
    ("a.b.c.d.e.f.g.h. z", "abcdefgh z"), ("Zoë́ 24x7", None), ("x² ½y", "x² ½y"),
]
ADDRESSES = [
    ("Apts", "apartments"), ("St.John", "streetjohn"), ("18St", "18 st"), ("Ste", "suite"), ("St.Rd x", "streetroad x"),
    ("Dr's", "drive s"), ("18Shakti  Rd.", "18 shakti road"), ("\tNr. Hwy 7\n", "near highway 7"), ("street", "street"),
]


@pytest.mark.parametrize("rows,words", [(NAMES, text.GENERAL), (ADDRESSES, text.ADDRESS)])
def test_normalisation_table(spark, rows, words):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, c string")
    got = {r.i: r.n for r in df.select("i", text.normalize(F.col("c"), words).alias("n")).collect()}
    for i, (given_, want) in enumerate(rows):
        if want is not None:
            assert got[i] == want, given_


def test_transliteration(spark):
    rows = [("Café €", True), ("Café", True), ("Москва", True), ("Αθήνα", True), ("भारत", True), ("plain é", False), (None, False)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, c string")
    got = {r.i: r for r in df.select("i", text.is_non_latin(F.col("c")).alias("o"), text.normalize(F.col("c"), {}).alias("n")).collect()}
    assert [got[i].o for i in range(len(rows))] == [r[1] for r in rows]
    assert got[0].n.startswith("cafe") and got[1].n == "cafe" and got[2].n == "moskva" and got[3].n == "athena"
    assert got[4].n.isascii() and got[4].n and got[5].n == "plain e" and got[6].n == ""
    assert translit.ascii_text("Ж") == "Zh" and translit.ascii_text("日本").isascii()


def test_stutters_are_collapsed(spark):
    df = spark.createDataFrame([("иииа aaaa",), ("aaaa",)], "c string")
    assert [r.n for r in df.select(text.normalize(F.col("c"), {}).alias("n")).collect()] == ["iia aa", "aaaa"]


def test_country(spark):
    rows = [(" US ", "us"), (None, ""), ("Straße", "strasse"), ("CÔTE", "côte")]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, c string")
    got = {r.i: r.n for r in df.select("i", text.normalize_country(F.col("c")).alias("n")).collect()}
    assert [got[i] for i in range(len(rows))] == [r[1] for r in rows]


def test_normalisation_is_idempotent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once = docs.select(text.normalize(F.col("text"), {}).alias("a"))
    assert once.select("a", text.normalize(F.col("a"), {}).alias("b")).where("a <> b").count() == 0


def test_char_wb(spark):
    df = spark.createDataFrame([("ab",), ("A  bcd",), ("",)], "c string")
    got = [r.g for r in df.select(tokens.char_wb(F.col("c")).alias("g")).collect()]
    assert got[0] == [" a", "ab", "b ", " ab", "ab ", " ab "]
    assert Counter(got[1]) == Counter([" a", "a ", " a ", " b", "bc", "cd", "d ", " bc", "bcd", "cd ", " bcd", "bcd "])
    assert got[2] == []
    assert all(similarity._gram_counts(t)[0] == dict(Counter(g)) for t, g in zip(("ab", "A  bcd", ""), got))


def test_tokens(spark):
    df = spark.createDataFrame([(" b aa b cc aa ",), ("",)], "c string")
    got = df.select(tokens.tokens(F.col("c")).alias("t"), tokens.blocking_tokens(F.col("c")).alias("k"), tokens.first_token(tokens.tokens(F.col("c"))).alias("f")).collect()
    assert (got[0].t, got[0].k, got[0].f) == (["b", "aa", "b", "cc", "aa"], ["aa", "cc"], "b")
    assert (got[1].t, got[1].k, got[1].f) == ([], [], "")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@given(st.text("abcé \U0001f600", max_size=40), st.text("abcé \U0001f600", max_size=40))
def test_ratio(a, b):
    assert similarity.lcs_length(a, b) == lcs(a, b)
    r = similarity.ratio(a, b)
    assert 0 <= r <= 1 and r == similarity.ratio(b, a) and (r == 1) == (a == b)
    assert similarity.cosine(a, b) == pytest.approx(similarity.cosine(b, a)) and similarity.cosine(a, b) < 1 + 1e-9


def test_pair_columns(spark):
    rng = random.Random(0)
    rows = [("", ""), ("", "a"), ("ab", "ba"), ("ab", "cd"), (None, None), *(("".join(rng.choices("abc d", k=9)), "".join(rng.choices("abc d", k=7))) for _ in range(40))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    a, b = F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))
    out = df.select("i", similarity.seq_ratio("a", "b").alias("r"), similarity.quick_ratio(a, b).alias("q"), similarity.jaccard(tokens.tokens(a), tokens.tokens(b)).alias("j")).collect()
    for r in out:
        x, y = (v or "" for v in rows[r.i])
        n = len(x) + len(y)
        assert r.r == pytest.approx(2 * lcs(x, y) / n if n else 1.0)
        assert r.q == pytest.approx(2 * sum((Counter(x) & Counter(y)).values()) / n if n else 1.0) and r.q >= r.r - 1e-12
        s, t = set(x.split()), set(y.split())
        assert r.j == pytest.approx(len(s & t) / len(s | t) if s | t else 1.0)


def test_acronyms_and_abbreviations_against_patterns(spark):
    import random
    import re

    from tessera.functions import text

    rng = random.Random(5)
    parts = ["a", "b", "S", ".", ".", ".", " ", "bank", "9", "-", "co", "cos", "st", "sts", "inc", "ste", "pvt", "é", "socty"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))) for i in range(600)] + [(600, "a.b.c.d.e.f.g.h.i.j. k"), (601, "p.v.t. x")]
    df = spark.createDataFrame(rows, "i int, t string")
    acronym = re.compile(r"\b(?:[A-Za-z]\.){2,}[A-Za-z]?\b")
    both = text.GENERAL | text.ADDRESS
    short = re.compile(rf"\b(?:{'|'.join(both)})s?\.?\b")

    def full(m):
        t = m.group(0).rstrip(".")
        return both[t] if t in both else both[t[:-1]] + "s"

    out = df.select("i", text.join_acronyms(F.col("t")).alias("a"), text.expand(F.col("t"), both).alias("e")).collect()
    for r in out:
        t = rows[r.i][1]
        assert r.a == acronym.sub(lambda m: m.group(0).replace(".", ""), t)
        assert r.e == short.sub(full, t)


def test_hangul_and_kana_are_spelt():
    assert [translit.ascii_of(c) for c in "한국어かガさザ"] == ["han", "gug", "eo", "ka", "ga", "sa", "za"]
    assert translit.ascii_of("й") == "i" and translit.ascii_of("é") == "e"


def test_batched_dots_against_dicts():
    rng = random.Random(4)

    def vector():
        if rng.random() < 0.2:
            return None, None
        keys = rng.sample("abcdefgh", rng.randint(0, 6))
        return keys, [rng.random() for _ in keys]

    rows = [(*vector(), *vector()) for _ in range(300)]
    arrays = [pa.array(list(x), pa.list_(t)) for x, t in zip(zip(*rows), [pa.string(), pa.float64()] * 2)]

    def plain(ka, wa, kb, wb):
        return sum(w * dict(zip(kb, wb)).get(k, 0.0) for k, w in zip(ka, wa)) if ka and kb else 0.0

    for part in (slice(0, 300), slice(50, 90), slice(0, 0)):
        got = similarity.dots(*[x[part] for x in arrays])
        assert got.tolist() == pytest.approx([plain(*r) for r in rows[part]])
    nothing = [pa.array([None, []], x.type) for x in arrays]
    assert similarity.dots(*nothing).tolist() == [0.0, 0.0]


def test_lcs_of_long_texts():
    deal, most = random.Random(5), similarity.SHORT
    for n, m in ((most - 1, 40), (most, 60), (most + 300, most + 100)):
        a, b = ("".join(deal.choices("abc é\U0001f600\ud800", k=k)) for k in (n, m))
        assert similarity.lcs_length(a, b) == similarity.lcs_length(b, a) == lcs(a, b)


def test_ratios_of_many_texts_go_together(monkeypatch):
    """Texts of like length share one integer and do not touch each other; near copies, blanks and short ones go alone."""
    deal, joined, real = random.Random(8), [], similarity._joined_lengths
    monkeypatch.setattr(similarity, "_joined_lengths", lambda *x: joined.append(len(x[0])) or real(*x))
    text = lambda n: "".join(deal.choices("abcdeé 😀z", k=n))
    for n in (1, 40, 300, 1500):
        b = text(n)
        texts = ["", b, b[: n // 2] + "y" + b[n // 2 :], "a" * n, text(3 * n), *[text(n) for _ in range(5)], text(n // 9), b * 2]
        for room in (200_000, 2 * n):
            monkeypatch.setattr(similarity, "JOINED", room)
            got = similarity.ratios(texts, b)
            assert got == [1.0 if not a and not b else 2.0 * lcs(a, b) / (len(a) + len(b)) for a in texts]
    assert max(joined) > 5
    assert similarity.ratios(["", "a"], "") == [1.0, 0.0]
