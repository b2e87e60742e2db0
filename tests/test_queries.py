import collections
import inspect
import math
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import entities, features, model
from tessera.plans import fixtures, oracle, queries
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_against_sql(spark, name):
    if name in oracle.SQL:
        assert compare(spark, SF, queries.QUERIES[name], oracle.SQL[name]) == ""
    else:
        assert queries.QUERIES[name](spark, SF).count() > 0


def test_gbt_predict_trains_the_whole_model(spark, monkeypatch):
    asked, fit = [], model.fit

    def small(rows, *args, **named):
        bound = inspect.signature(fit).bind(rows, *args, **named)
        bound.apply_defaults()
        asked.append((bound.arguments["max_iter"], bound.arguments["max_depth"], bound.arguments["step"]))
        return fit(rows, max_iter=1, max_depth=2)

    monkeypatch.setattr(model, "fit", small)
    assert queries.gbt_predict(spark, SF).columns == ["source1_entity_id", "candidate_entity_id", "label", "prob"]
    assert asked == [(200, 6, 0.05)]


def lcs(a, b):
    """Row by row: the best with a letter of ``b`` more."""
    codes, row = np.array([ord(c) for c in a], np.int64), np.zeros(len(a) + 1, np.int64)
    for c in b:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(codes == ord(c), row[:-1] + 1, 0)))
    return int(row[-1])


def ratio(a, b):
    return 1.0 if not a and not b else 2.0 * lcs(a, b) / (len(a) + len(b))


def jaccard(a, b):
    x, y = set(a.split()), set(b.split())
    return len(x & y) / len(x | y) if x | y else 1.0


def grams(name):
    out = collections.Counter()
    for w in name.lower().split():
        for n in (2, 3, 4):
            out.update(f" {w} "[i : i + n] for i in range(len(w) + 3 - n))
    return out


def test_feature_rows_and_address_ratio_against_brute_force(spark):
    e = {r.entity_id: r for r in fixtures.entities(spark, SF).collect()}
    rows = queries.feature_rows(spark, SF).collect()
    needed = {x for r in rows for x in (r.source1_entity_id, r.candidate_entity_id)}
    counts = {x: grams(e[x].business_name_clean) for x in needed}
    df = collections.Counter(g for c in counts.values() for g in c)
    idf = {g: math.log((1 + len(needed)) / (1 + n)) + 1 for g, n in df.items() if n >= 2}
    vectors = {x: {g: n * idf[g] for g, n in c.items() if g in idf} for x, c in counts.items()}
    norm = {x: math.sqrt(sum(w * w for w in v.values())) for x, v in vectors.items()}
    true = {(r.source1_entity_id, r.candidate_entity_id) for r in entities.explode_truth(fixtures.ground_truth(spark, SF)).collect()}
    assert len(rows) > 50
    for r in rows:
        a, b = e[r.source1_entity_id], e[r.candidate_entity_id]
        x, y = a.business_name_clean, b.business_name_clean
        both = norm[a.entity_id] * norm[b.entity_id]
        dot = sum(w * vectors[b.entity_id].get(g, 0.0) for g, w in vectors[a.entity_id].items())
        first = lambda s: s.split(" ")[0]
        want = [jaccard(x, y), ratio(x, y), dot / both if both else 0.0, jaccard(a.business_address_clean, b.business_address_clean), ratio(a.business_address_clean, b.business_address_clean)]
        want += [int(a.country_clean == b.country_clean), abs(len(x) - len(y)), int(first(x) == first(y) != ""), int((a.entity_id, b.entity_id) in true)]
        assert [*r][2:] == pytest.approx(want, abs=1e-5)
    pairs = {(r.source1_entity_id, r.candidate_entity_id): r.address_seq_ratio for r in rows}
    assert {(r.source1_entity_id, r.candidate_entity_id): r.address_seq_ratio for r in queries.address_ratio(spark, SF).collect()} == pairs


def test_records_hold_whole_texts(spark):
    whole = {f"d{r.doc_id}": (r.text or "").split() for r in fixtures.documents(spark, SF).collect()}
    got = {r.entity_id: f"{r.business_name} {r.business_address}".split() for r in fixtures.source_records(spark, SF).collect()}
    assert got == whole


def test_probabilities_are_sums_of_trees(spark):
    rows = queries.feature_rows(spark, SF).cache()
    fitted = model.fit(rows, max_iter=4, max_depth=3)
    trees = fitted.stages[-1]
    for r in model.predict_proba(fitted, rows).collect():
        x = Vectors.dense([float(r[f]) for f in features.FEATURES])
        margin = sum(w * t.predict(x) for w, t in zip(trees.treeWeights, trees.trees))
        assert r.prob == pytest.approx(1 / (1 + math.exp(-2 * margin)))
    rows.unpersist()


def test_first_rows_and_sample(spark):
    df = spark.createDataFrame([(i % 7, f"g{i}") for i in range(200)], "total int, gram string").repartition(5)
    order = F.col("total").desc(), F.col("gram")
    for n in (0, 1, 50, 200, 500):
        got = {tuple(r) for r in features.first_rows(df, n, *order).collect()}
        assert got == {tuple(r) for r in df.orderBy(*order).limit(n).collect()}
    e = fixtures.entities(spark, SF)
    some = features.first_rows(e.withColumn("o", F.xxhash64("entity_id", F.lit(42))), 30, F.col("o"), F.col("entity_id"))
    want = features.fit_idf(some)
    assert sorted(map(tuple, features.fit_idf(e, sample=30).collect())) == sorted(map(tuple, want.collect())) != []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_import_needs_no_session():
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries(); e.oracle_sql()"], check=True, cwd=entry.__file__.rpartition("/")[0])


def test_library_never_imports_the_corpus_operators():
    import ast
    from pathlib import Path

    top = Path(entry.__file__).parent / "tessera"
    for p in top.rglob("*.py"):
        if "llm" in p.relative_to(top).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), p
