import random
import re

import pytest

from tessera.llm import substring_dedup as sd

from . import fixtures


def brute(rows, window):
    words = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    first: dict = {}
    for d, w in words:
        if d is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s : s + window])
                first[k] = min(first.get(k, (d, s)), (d, s))
    out = []
    for d, w in words:
        gone = set()
        if d is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s : s + window])] < (d, s):
                    gone.update(range(s, s + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def passages(seed, vocabulary):
    rng = random.Random(seed)
    some = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(15, 90))] for _ in range(12)]
    rows = []
    for i in range(150):
        w: list[str] = []
        for _ in range(rng.randrange(0, 5)):
            w += [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(0, 40))]
            p = rng.choice(some)
            a, b = sorted((rng.randrange(len(p) + 1), rng.randrange(len(p) + 1)))
            w += p[a:b] if rng.random() < 0.5 else p
        rows.append((rng.randrange(10_000) * 150 + i, " ".join(w)))
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("vocabulary,batches,held", [(5, 1, 10**6), (2000, 1, 50), (2000, 3, 10**6), (40, 6, 300)])
def test_against_all_windows(spark, monkeypatch, vocabulary, batches, held):
    monkeypatch.setattr(sd, "HELD_UNITS", held)
    rows = passages(vocabulary + batches, vocabulary)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sd.dedup_substrings(docs, batches=batches)) == brute(rows, 20)


def test_tables_and_odd_rows(spark):
    for docs in (fixtures.frame(spark), fixtures.small(spark)):
        assert got(sd.dedup_substrings(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    assert got(sd.dedup_substrings(fixtures.frame(spark, []))) == []


def test_rows_of_one_document(spark):
    w = fixtures.WORDS
    rows = [(1, w), (1, w), (1, "x " + w), (None, w), (None, None), (2, w + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sd.dedup_substrings(docs)) == brute(rows, 20)


def test_index_is_compacted(spark):
    rows = sorted(passages(9, 300))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = sd.SubstringIndex(spark, fanout=2)
    found = None
    for k in range(5):
        index.add(sd.batch_units(docs.where(f"doc_id in ({', '.join(str(d) for d, _ in rows[k * 30 : k * 30 + 30])})"), index.windows))
        spans = index.spans(docs.limit(30 * k + 30), k)
        found = spans if found is None else found.union(spans)
    assert [len(x) for x in index.levels] == [1, 0, 1]
    assert got(sd.remove_spans(docs, found)) == brute(rows, 20)
    assert got(sd.remove_spans(docs, index.spans(docs))) == brute(rows, 20)
    # A run is in order and holds each key once.
    keys = [(r.mh, r.uh) for r in spark.read.parquet(*[p for _, p in index._runs()]).where("kind = 1").collect()]
    assert len(keys) == len(set(keys))
    index.drop()


def test_a_run_does_not_move(spark):
    docs = spark.createDataFrame(passages(4, 300), "doc_id long, text string")
    index = sd.SubstringIndex(spark)
    index.add(sd.batch_units(docs.where("doc_id < 700000"), index.windows))
    name = index._runs()[0][0]
    rows = sd.batch_units(docs.where("doc_id >= 700000"), index.windows).repartition(index.buckets, "mh", "uh")
    plan = rows.join(index._firsts(name).hint("merge"), ["mh", "uh"], "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    index.drop()
