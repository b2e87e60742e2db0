"""Queries whose candidates are the best of all pairs that share a distinctive token, with no cap before the score."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking, tiles
from tests.test_operators import frame, pool
from tests.test_tiles import got, records, small  # noqa: F401

FEW = blocking.Blocking(k=4, max_candidates=None, max_df_ratio=0.5, max_postings=None)


@pytest.mark.parametrize("section", [1, 13, 50_000])
def test_whole_sections_against_joins(spark, monkeypatch, small, section):  # noqa: F811
    monkeypatch.setattr(tiles, "SECTION", section)
    e = frame(spark, records())
    rows = blocking._tiled(e, FEW).toArrow().to_batches(max_chunksize=11)
    found = [tuple(r.values()) for b in tiles.best(iter(rows), 2, None, FEW.k, FEW.sim_floor) for r in b.to_pylist()]
    assert sorted(found) == got(blocking.plain_candidates(e, FEW)) == got(blocking.candidates(e, FEW)) != []
    assert len(got(blocking.candidates(e, FEW))) != len(got(blocking.candidates(e, blocking.Blocking(k=4, max_candidates=2, max_df_ratio=0.5, max_postings=2))))


def crowded(spark):
    """The best match of ``a`` shares its one token with more records than the cap takes, and comes last by id."""
    far = [(f"m{i:04}", 2, f"acme q{i}zzzzzzzz", "us") for i in range(305)]
    return frame(spark, [("a", 1, "acme tooling", "us"), *far, ("z", 3, "acme toolings", "us"), *pool(8000)])


def test_a_better_match_beyond_the_cap_is_found(spark):
    e = crowded(spark)
    best = blocking.candidates(e, blocking.WHOLE).orderBy(F.desc("blocking_score")).first()
    assert best.candidate_entity_id == "z"
    assert got(blocking.candidates(e, blocking.WHOLE)) == got(blocking.plain_candidates(e, blocking.WHOLE))
    assert "z" not in {r.candidate_entity_id for r in blocking.candidates(e).collect()}


def test_one_cap_without_the_other(spark):
    e = frame(spark, records(90))
    for some in (blocking.Blocking(max_df_ratio=0.5, max_postings=3, max_candidates=None), blocking.Blocking(max_df_ratio=0.5, max_postings=None, max_candidates=3)):
        assert got(blocking.candidates(e, some)) == got(blocking.plain_candidates(e, some)) != []


def written(tmp_path):
    """Documents as in :func:`crowded`: one text is beyond the caps for the first."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    texts = [("acme tooling", "src0"), *[(f"acme q{i}zzzzzzzz", "src9") for i in range(305)], ("acme toolings", "src15"), *[(f"filler{i} word{i}", "src9") for i in range(8000)]]
    ids = range(1000, 1000 + len(texts))
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": [t for t, _ in texts], "lang": ["en"] * len(texts), "source": [s for _, s in texts]}), f"{tmp_path}/documents.parquet")
    return str(tmp_path)


#: What is found of the first document and the last that its cap left out; nothing with the caps.
FOUND = {
    "blocking_topk": lambda rows: [r[:2] for r in rows] == [("d1000", "d1306")],
    "candidate_counts": lambda rows: rows == [(1, 1)],
    "label_counts": lambda rows: rows == [(0, 1, 0.5)],
    "name_jaccard": lambda rows: rows == [("d1000", "d1306", 0.333333)],
}


@pytest.mark.parametrize("name", list(FOUND))
def test_query_beyond_the_cap_against_sql(spark, tmp_path, name):
    from tessera.plans import oracle, queries
    from tests.oracle import compare

    sf = written(tmp_path)
    assert compare(spark, sf, queries.QUERIES[name], oracle.SQL[name]) == ""
    assert FOUND[name](got(queries.QUERIES[name](spark, sf)))
