"""Features from tiles and from names, against the same by joins; plans copy no text or vector into every pair."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import features, meetings
from tests.test_operators import CLEAN

deal = random.Random(3)
WORDS = ["", "acme", "tools", "x", "été", *[f"w{i}" for i in range(30)]]


@pytest.fixture
def sides(spark, monkeypatch):
    monkeypatch.setattr(features, "HELD", 5)
    name = lambda n: " ".join(w for w in deal.choices(WORDS, k=deal.randrange(n)) if w)
    e = spark.createDataFrame([(f"e{i}", 1 + i % 3, i, name(6), name(40), deal.choice(["us", "fr", ""])) for i in range(60)], CLEAN)
    pairs = spark.createDataFrame(list({(f"e{3 * deal.randrange(20)}", f"e{3 * deal.randrange(20) + 1}") for _ in range(150)}), "source1_entity_id string, candidate_entity_id string")
    return e, pairs


def by_pair(df, *cols):
    return {(r.source1_entity_id, r.candidate_entity_id): [r[c] for c in cols] for r in df.collect()}


def test_address_features_against_joins(spark, sides):
    e, pairs = sides
    out = features.address_features(pairs, e, True)
    assert "s1_" not in out._jdf.queryExecution().optimizedPlan().toString()
    cols = ("address_token_jaccard", "address_seq_ratio")
    got, want = by_pair(out, *cols), by_pair(features._joined_rows(pairs, e, None, None), *cols)
    assert got.keys() == want.keys() and len(got) > 50
    assert all(got[p] == pytest.approx(want[p]) for p in got)


def test_name_cosines_against_vectors(spark, sides):
    e, pairs = sides
    idf = features.fit_idf(e)
    out = features.name_cosines(pairs, e, idf)
    assert "weights" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = by_pair(out, "name_tfidf_cosine")
    want = by_pair(features.tfidf_cosine(pairs, features.tfidf_vectors(e, idf)), "name_tfidf_cosine")
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in got) and any(v[0] > 0 for v in got.values())


def test_feature_rows_against_joins(spark, sides):
    e, pairs = sides
    got, want = by_pair(features.feature_rows(pairs, e), *features.FEATURES), by_pair(features._joined_rows(pairs, e, None, None), *features.FEATURES)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in got)
    twice = e.union(e.limit(1))
    assert features.feature_rows(pairs, twice).count() == features._joined_rows(pairs, twice, None, None).count()


def test_feature_rows_carry_no_token_arrays(spark, sides, monkeypatch):
    def refuse(*args):
        raise AssertionError("tokens of both sides in every pair")

    monkeypatch.setattr(features, "lookup", refuse)
    e, pairs = sides
    assert features.feature_rows(pairs, e).columns == ["source1_entity_id", "candidate_entity_id", *features.FEATURES]


def test_ratios_move_texts_in_rounds(spark, sides, monkeypatch):
    monkeypatch.setattr(features, "HELD_WHOLE", 2)
    monkeypatch.setattr(features, "LEAST_ROUND", 1)
    e, pairs = sides
    e = e.withColumn("country_clean", F.when(F.col("country_clean") != "", F.col("country_clean")))  # a null country is one, too
    moved, whole = [], features._met_texts

    def counted(met, entities, *rest):
        sides = [met.select("tile", c) for c in ("source1_entity_id", "candidate_entity_id")]
        moved.append((sides[0].union(sides[1]).distinct().count(), met.select("tile").distinct().count()))
        return whole(met, entities, *rest)

    monkeypatch.setattr(features, "_met_texts", counted)
    cols = ("address_token_jaccard", "address_seq_ratio")
    got, want = by_pair(features.address_features(pairs, e, True), *cols), by_pair(features._joined_rows(pairs, e, None, None), *cols)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in got)
    assert len(moved) > 1 and all(n <= 60 for n, tiles in moved if tiles > 1)
    assert any(r._country != r._there for r in _dealt(pairs, e))


def _dealt(pairs, e):
    country = e.select("entity_id", F.coalesce("country_clean", F.lit("")).alias("c"))
    left, right = (country.toDF(key, name) for key, name in (("source1_entity_id", "_country"), ("candidate_entity_id", "_there")))
    return pairs.join(left, "source1_entity_id").join(right, "candidate_entity_id").collect()


def test_rounds_hold_no_more_than_all_texts(spark, monkeypatch):
    monkeypatch.setattr(features, "LEAST_ROUND", 1)
    met = spark.createDataFrame([("us", f"{t}:us", f"a{t}", f"b{i}", "fr" if t == 5 else "us") for t in range(6) for i in range(9)], "_country string, tile string, source1_entity_id string, candidate_entity_id string, _there string")
    assert features.rounds(met, 25) == [(["0:us", "1:us"], ["us"]), (["2:us", "3:us"], ["us"]), (["4:us", "5:us"], ["fr", "us"])]
    assert [len(tiles) for tiles, _ in features.rounds(met, 5)] == [1] * 6
    assert features.rounds(met.limit(0), 5) == []


def test_records_of_one_name_meet_together(spark, monkeypatch):
    monkeypatch.setattr(features, "HELD_WHOLE", 3)
    rows = [*[(f"a{i}", 1, i, "acme", f"acme street {i % 4} north", "us") for i in range(8)], *[(f"b{i}", 1, i, f"other{i}", f"road {i}", "us") for i in range(20)], *[(f"m{i}", 2, i, "acme", "acme street south", "us") for i in range(3)]]
    e = spark.createDataFrame(rows, CLEAN)
    pairs = spark.createDataFrame([(s[0], f"m{i}") for s in rows[:28] for i in range(3)], "source1_entity_id string, candidate_entity_id string")
    seen, real = [], features._met_texts
    monkeypatch.setattr(features, "_met_texts", lambda met, *x: seen.append(met.select("tile", "source1_entity_id").distinct().collect()) or real(met, *x))
    out = by_pair(features.address_features(pairs, e, True), "address_seq_ratio")
    assert len({r.tile for some in seen for r in some if r.source1_entity_id.startswith("a")}) == 1 < len({r.tile for some in seen for r in some})
    want = by_pair(features._joined_rows(pairs, e, None, None), "address_seq_ratio")
    assert out == want and len(out) == 84


def test_equal_texts_are_compared_once(monkeypatch):
    asked = []
    monkeypatch.setattr(meetings, "ratios", lambda texts, b, places: asked.append((tuple(texts), b)) or [0.5] * len(texts))
    held = meetings._Texts(True)
    held.add(["a", "b", "c"], ["x y", "x y", "z"])
    assert held.meet("q", ["a", "b", "c"])[1] == [0.5] * 3 == held.meet("q", ["c", "a", "b"])[1]
    assert asked[0] == (("x y", "z"), "q") and all(not texts for texts, _ in asked[1:])
