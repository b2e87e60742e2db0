"""Candidates by tiles against the same by joins, in many small sections and tiles."""

import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking, tiles
from tests.test_operators import frame, pool

SMALL = blocking.Blocking(k=4, max_candidates=9, max_df_ratio=0.5, max_postings=25)


def records(n=240):
    deal = random.Random(5)
    words = ["acme", "tools", "rare", "x", "ab", "İzmir", "straße", "été", *[f"w{i}" for i in range(25)]]
    return [(f"e{i}", 1 + i % 3, " ".join(deal.choices(words, k=deal.randrange(7))), deal.choice(["us", "us", "fr", ""])) for i in range(n)]


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(blocking, "LEAST_TILE", 7)
    monkeypatch.setattr(blocking, "TILES", 3)


@pytest.mark.parametrize("section", [1, 13, 50_000])
def test_sections_against_joins(spark, monkeypatch, small, section):
    monkeypatch.setattr(tiles, "SECTION", section)
    e = frame(spark, records())
    # the kernel runs here, as a worker would not see the smaller section
    rows = blocking._tiled(e, SMALL).toArrow().to_batches(max_chunksize=11)
    found = [tuple(r.values()) for b in tiles.best(iter(rows), 2, SMALL.max_candidates, SMALL.k, SMALL.sim_floor) for r in b.to_pylist()]
    assert sorted(found) == got(blocking.plain_candidates(e, SMALL)) != []


def test_all_capped_pairs_against_joins(spark, small):
    e = frame(spark, records())
    s1, p = e.where("source = 1"), e.where("source <> 1")
    want = blocking.score(blocking.cap_candidates(blocking.blocking_pairs(s1, p, SMALL), SMALL), s1, p)
    assert got(blocking.capped_scores(e, SMALL)) == got(want.select("source1_entity_id", "candidate_entity_id", "blocking_score")) != []


def test_repeated_and_null_ids(spark):
    e = frame(spark, [*records(60), ("e0", 1, "acme rare", "us"), ("e1", 2, "acme rare w3", "fr"), (None, 1, "acme rare", "us"), (None, 2, "acme rare", "us")])
    assert got(blocking.candidates(e, SMALL)) == got(blocking.plain_candidates(e, SMALL)) != []


def test_no_table_of_pairs(spark):
    """Records that all share a token make no row for each pair before the cap."""
    e = frame(spark, [*[(f"a{i}", 1, f"acme one{i}", "us") for i in range(300)], *[(f"m{i}", 2, f"acme two{i}", "us") for i in range(300)], *pool(6000)])
    out = blocking.candidates(e)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "n_shared" not in plan and out.count() == got_count(e)


def got_count(e):
    return blocking.plain_candidates(e).count()


def test_rounding_is_that_of_spark(spark):
    deal = random.Random(1)
    x = [*[deal.random() for _ in range(2000)], *[i / 1e6 + 5e-7 for i in range(0, 900_000, 977)], 0.0, 1.0, 0.5000005]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(F.round("x", 6)).collect()]
    assert list(tiles.micros(np.array(x)) / 1e6) == want
    assert float(Decimal(repr(x[-1])).quantize(Decimal("0.000001"), ROUND_HALF_UP)) == want[-1]
