from pyspark.sql import functions as F

from tessera.operators.entities import normalize_entities
from tessera.plans import cli, fixtures
from tessera.sources import tsv
from tessera.streaming import normalize

SF = "/root/testdata/sf0.001"


def test_four_stages_over_files(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    records = fixtures.source_records(spark, SF).cache()
    # The first documents' names are split: the same records under two ids make true pairs.
    twins = records.where("source = 1").withColumns({"entity_id": F.concat(F.lit("t"), "entity_id"), "source": F.lit(2)})
    truth = twins.select(F.expr("substr(entity_id, 2)").alias("source1_entity_id"), F.col("entity_id").alias("matched_entity_ids"))
    tsv.write_tsv(truth, at("truth"))
    for i in (1, 2, 3):
        part = records.where(F.col("source") == i)
        part = part.unionByName(twins) if i == 2 else part
        tsv.write_tsv(part.drop("source", "ord"), at(f"s{i}"))
        cli.main(["normalize", at(f"s{i}"), at(f"n{i}")])
    n = [at(f"n{i}") for i in (1, 2, 3)]
    cli.main(["block", "--s1", n[0], "--s2", n[1], "--s3", n[2], "--audit-only", "--ground-truth", at("truth")])
    cli.main(["block", "--s1", n[0], "--s2", n[1], "--s3", n[2], "--out-long", at("long"), "--out-wide", at("wide"), "--ground-truth", at("truth")])
    cli.main(["block", "--s1", n[0], "--s2", n[1], "--s3", n[2], "--out-wide", at("dry"), "--dry-run", "5"])
    assert tsv.read_tsv(spark, at("dry")).count() == 5
    cli.main(["features", "--pairs", at("long"), "--sources", *n, "--out", at("features"), "--ground-truth", at("truth")])
    assert tsv.read_tsv(spark, at("features")).count() == tsv.read_tsv(spark, at("long")).count() > 0
    cli.main(["train", "--features", at("features"), "--model", at("model"), "--threshold", at("threshold"), "--trees", "3"])
    cli.main(["predict", "--features", at("features"), "--candidates", at("wide"), "--model", at("model"), "--threshold", at("threshold"), "--out", at("matches"), "--out-candidates", at("passed")])
    wide, matches = (tsv.read_tsv(spark, at(x)) for x in ("wide", "matches"))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, tsv.read_tsv(spark, at("passed")).collect()))
    order = {r.source1_entity_id: r.candidate_entity_ids.split(",") for r in wide.collect()}
    for r in matches.where("matched_entity_ids <> ''").collect():
        places = [order[r.source1_entity_id].index(x) for x in r.matched_entity_ids.split(",")]
        assert places == sorted(places)
    assert wide.count() == matches.count() == records.where("source = 1").count()
    assert wide.where("candidate_entity_ids <> ''").count() > 0
    assert matches.join(truth.withColumnRenamed("matched_entity_ids", "twin"), "source1_entity_id").where("matched_entity_ids like concat('%', twin, '%')").count() > 0
    records.unpersist()


def test_stream_equals_batch(spark, tmp_path):
    records = fixtures.source_records(spark, SF).drop("source", "ord")
    tsv.write_tsv(records.repartition(3), str(tmp_path / "in"))
    q = normalize.write_stream(normalize.stream_sources(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
    assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = normalize_entities(tsv.fill_blank(records))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
