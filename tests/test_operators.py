import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking, entities, features, model
from tessera.sources import tsv
from tessera.workspace import new_path

CLEAN = "entity_id string, source int, ord long, business_name_clean string, business_address_clean string, country_clean string"


def frame(spark, rows):
    return spark.createDataFrame([(i, s, k, n, n, c) for k, (i, s, n, c) in enumerate(rows)], CLEAN)


def pool(n, country="us"):
    return [(f"x{i}", 2, f"filler{i} word{i}", country) for i in range(n)]


def test_blank_countries_block_together_and_with_no_other(spark):
    e = frame(spark, [("a", 1, "acme tools", ""), ("b", 2, "acme tools", ""), ("c", 2, "acme tools", "us"), *pool(45), *[(f"y{i}", 3, f"other{i}", "") for i in range(45)]])
    assert [tuple(r)[:2] for r in blocking.candidates(e).collect()] == [("a", "b")]


@pytest.mark.parametrize("n,found", [(39, 0), (40, 2)])
def test_df_cut_changes_at_forty_records(spark, n, found):
    e = frame(spark, [("a", 1, "acme tools", "us"), ("b", 2, "acme tools", "us"), ("c", 3, "acme tools", "us"), *pool(n - 2)])
    assert blocking.candidates(e).count() == found


def test_no_candidates(spark):
    p = pool(10)
    assert blocking.candidates(frame(spark, [("a", 1, "q w e", "us"), *p])).count() == 0
    assert blocking.candidates(frame(spark, [("a", 1, "filler1", "fr"), *p])).count() == 0
    assert blocking.candidates(frame(spark, [("a", 1, "filler1", "us")])).count() == 0
    assert blocking.candidates(frame(spark, p)).count() == 0
    empty = blocking.to_wide(blocking.candidates(frame(spark, p)), frame(spark, [("a", 1, "", "")]).select(F.col("entity_id").alias("source1_entity_id")))
    assert [tuple(r) for r in empty.collect()] == [("a", "")]


def test_caps_and_ties(spark):
    rows = [("a", 1, "acme rare", "us"), *[(f"m{i:03}", 2, "acme rare", "us") for i in range(30)], *pool(800)]
    e = frame(spark, rows)
    got = blocking.candidates(e).orderBy("candidate_entity_id").collect()
    assert [r.candidate_entity_id for r in got] == [f"m{i:03}" for i in range(20)] and {r.blocking_score for r in got} == {1.0}
    s1, p = e.where("source = 1"), e.where("source <> 1")
    few = blocking.Blocking(max_candidates=7, max_postings=9)
    pairs = blocking.blocking_pairs(s1, p, few)
    assert pairs.count() == 9 and {r.n_shared for r in pairs.collect()} == {2}
    assert sorted(r.candidate_entity_id for r in blocking.cap_candidates(pairs, few).collect()) == [f"m{i:03}" for i in range(7)]
    wide = blocking.to_wide(blocking.candidates(e), s1.select(F.col("entity_id").alias("source1_entity_id"))).first()
    assert wide.candidate_entity_ids == ",".join(f"m{i:03}" for i in range(20))


def test_same_result_for_any_number_of_partitions(spark):
    e = frame(spark, [*[(f"a{i}", 1, f"acme rare{i % 7} tool", "us") for i in range(20)], *[(f"m{i:03}", 2 + i % 2, f"acme rare{i % 9}", "us") for i in range(60)], *pool(900)])
    one = sorted(map(tuple, blocking.candidates(e).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, blocking.candidates(e.repartition(9)).collect())) == one and one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def truth(spark, rows):
    return spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")


def test_ground_truth_lists(spark):
    t = truth(spark, [("a", " x , y"), ("a", "x"), ("b", ""), ("c", None), ("d", "gone")])
    assert sorted(map(tuple, entities.explode_truth(t).collect())) == [("a", "x"), ("a", "x"), ("a", "y"), ("d", "gone")]
    pairs = spark.createDataFrame([("a", "x"), ("a", "z"), ("d", "gone")], "source1_entity_id string, candidate_entity_id string")
    assert sorted(map(tuple, features.label(pairs, t).collect())) == [("a", "x", 1), ("a", "z", 0), ("d", "gone", 1)]


def test_country_audit(spark):
    e = frame(spark, [("a", 1, "n", "us"), ("x", 2, "n", "us"), ("y", 2, "n", "fr"), ("z", 3, "n", "")])
    t = truth(spark, [("a", "x,y,unknown"), ("nobody", "unknown")])
    row = entities.country_mismatch(t, e).first()
    assert (row.mismatches, row.total_pairs, row.pct, row.warn) == (2, 4, 50.0, True)
    assert entities.country_mismatch(truth(spark, [("a", "")]), e).first().pct == 0.0
    assert [r.candidate_entity_id for r in entities.mismatch_examples(t, e).collect()] == ["unknown", "y"]
    assert sorted(map(tuple, entities.country_counts(e).collect())) == [(1, "us", 1), (2, "fr", 1), (2, "us", 1), (3, "", 1)]
    assert {r.source: r.n_blank for r in entities.blank_counts(e).collect()} == {1: 0, 2: 0, 3: 1}


def test_feature_rows(spark):
    e = frame(spark, [("a", 1, "acme tools", "us"), ("b", 2, "acme tool", "us"), ("c", 3, "", "fr"), ("d", 1, "", "fr")])
    pairs = spark.createDataFrame([("a", "b"), ("d", "c"), ("a", "c"), ("a", "unknown")], "source1_entity_id string, candidate_entity_id string")
    out = features.feature_rows(pairs, e, truth(spark, [("a", "b")]))
    assert out.columns == ["source1_entity_id", "candidate_entity_id", *features.FEATURES, "label"]
    got = {(r.source1_entity_id, r.candidate_entity_id): r for r in out.collect()}
    assert len(got) == 3
    r = got["a", "b"]
    assert r.name_token_jaccard == pytest.approx(1 / 3) and r.name_seq_ratio == pytest.approx(2 * 9 / 19)
    assert (r.country_match, r.name_length_diff, r.name_first_token_match, r.label) == (1, 1, 1, 1)
    assert r.name_tfidf_cosine == pytest.approx(1.0)  # only grams of both names are known
    r = got["d", "c"]
    assert (r.name_token_jaccard, r.name_seq_ratio, r.name_tfidf_cosine, r.country_match, r.name_first_token_match) == (1.0, 1.0, 0.0, 1, 0)
    assert got["a", "c"].name_token_jaccard == 0.0 and got["a", "c"].country_match == 0


def scored(spark, rows):
    return spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, label int, prob double")


def test_f_beta_cases(spark):
    rows = [("none", "x", 0, 0.1), ("false", "x", 0, 0.9), ("missed", "x", 1, 0.1), ("hit", "x", 1, 0.9), ("hit", "x", 1, 0.9), ("half", "x", 1, 0.9), ("half", "y", 0, 0.9)]
    df = scored(spark, rows).withColumn("predicted", (F.col("prob") >= 0.5).cast("int"))
    half = 1.25 * 0.5 * 1 / (0.25 * 0.5 + 1)
    want = (1 + 0 + 0 + 1 + half) / 5
    row = model.macro_f_beta(df).first()
    assert (row.macro_f, row.n_entities) == (pytest.approx(want, abs=1e-6), 5)
    swept = {round(r.threshold, 2): r.macro_f for r in model.sweep(df).collect()}
    assert len(swept) == 45 and min(swept) == 0.1 and max(swept) == 0.98 and swept[0.5] == pytest.approx(want, abs=1e-6)
    assert swept[0.1] == pytest.approx((0 + 0 + 1 + 1 + half) / 5, abs=1e-6)


def test_lowest_of_tied_thresholds(spark):
    df = scored(spark, [("a", "x", 1, 0.5), ("a", "y", 0, 0.31)])
    best = model.best_threshold(model.sweep(df)).first()
    assert (best.threshold, best.macro_f) == (0.32, 1.0)
    lists = model.match_lists(scored(spark, [("a", "x", 1, 0.5), ("a", "y", 0, 0.6), ("b", "z", 0, 0.1)]), df.select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("source1_entity_id")), 0.5)
    assert sorted(map(tuple, lists.collect())) == [("a", "y,x"), ("b", "")]
    assert tuple(model.list_counts(lists, "matched_entity_ids").first()) == (2, 1)


def test_model_round_trip(spark):
    rows = [(f"a{i}", f"x{i}", *([v] * 5), int(i % 2), i % 3, int(v > 0.5), int(v > 0.6)) for i in range(60) for v in [(i * 37 % 60) / 60]]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, " + ", ".join(f"{f} double" for f in features.FEATURES[:5]) + ", country_match int, name_length_diff int, name_first_token_match int, label int")
    path = new_path(spark, "model")
    model.save(model.fit(df, max_iter=3, max_depth=3), path)
    got = model.predict_proba(model.load(path), df).collect()
    assert all((r.prob > 0.5) == (r.label == 1) for r in got)
    assert {r.label: r.weight for r in model.class_weights(df).collect()}[1] == pytest.approx(60 / (2 * sum(r[-1] for r in rows)))
    tsv.write_json_row(spark, path + ".json", threshold=0.32, val_f0_5=0.9)
    assert tsv.read_json_row(spark, path + ".json") == {"threshold": 0.32, "val_f0_5": 0.9}


def test_split_keeps_entities_whole(spark):
    df = spark.range(5000).select(F.concat(F.lit("e"), "id").alias("e"))
    share = df.where(model.in_validation(F.col("e"))).count() / 5000
    assert 0.17 < share < 0.23


def test_dry_run(spark):
    e = frame(spark, [(f"a{i}", 1 + i % 3, "n", "us") for i in range(90)])
    got = entities.dry_run(e, 2)
    assert {r.source: r["count"] for r in got.groupBy("source").count().collect()} == {1: 2, 2: 20, 3: 20}
    assert got.columns == e.columns


def test_tsv(spark, tmp_path):
    raw = 'entity_id\tbusiness_name\tbusiness_address\tcountry\textra\na\t"He said ""hi"""\t"two\nlines"\tNA\t1\n007\tNone\t padded \tnull\t2\nb\tnan\t\tUS\t3\n'
    (tmp_path / "in.tsv").write_text(raw)
    df = tsv.read_tsv(spark, str(tmp_path / "in.tsv"), tsv.SOURCE)
    assert sorted(map(tuple, df.collect())) == [("007", "", " padded ", ""), ("a", 'He said "hi"', "two\nlines", ""), ("b", "", "", "US")]
    assert tsv.read_tsv(spark, str(tmp_path / "in.tsv"), ("entity_id", "extra"), numeric={"extra": "int"}).dtypes == [("entity_id", "string"), ("extra", "int")]
    with pytest.raises(ValueError, match="missing columns: nothing"):
        tsv.read_tsv(spark, str(tmp_path / "in.tsv"), ("entity_id", "nothing"))
    out = entities.normalize_entities(df).withColumn("ids", F.array(F.lit("p"), F.lit("q")))
    tsv.write_tsv(out, str(tmp_path / "out.tsv"))
    back = tsv.read_tsv(spark, str(tmp_path / "out.tsv"))
    assert sorted((r.entity_id, r.business_address, r.was_transliterated, r.ids) for r in back.collect()) == [("007", " padded ", "False", "p,q"), ("a", "two\nlines", "False", "p,q"), ("b", "", "False", "p,q")]
    with pytest.raises(ValueError):
        entities.normalize_entities(df.drop("country"))
