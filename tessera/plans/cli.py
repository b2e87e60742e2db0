"""The four stages as commands over tab-separated files.

python -m tessera.plans.cli normalize IN OUT
python -m tessera.plans.cli block --s1 F --s2 F --s3 F --out-long F --out-wide F [--ground-truth F] [--audit-only] [--dry-run N]
python -m tessera.plans.cli features --pairs F --sources F F F --out F [--ground-truth F]
python -m tessera.plans.cli train --features F --model DIR --threshold F
python -m tessera.plans.cli predict --features F --candidates F --model DIR --threshold F --out F [--out-candidates F]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import blocking, entities, features, model
from tessera.sources import tsv
from tessera.workspace import materialize

BLOCKING_INPUT = ("entity_id", "business_name_clean", "country_clean")
LOOKUP_INPUT = ("entity_id", "business_name_clean", "business_address_clean", "country_clean")


def normalize_file(spark: SparkSession, path: str, out: str) -> None:
    tsv.write_tsv(entities.normalize_entities(tsv.require(tsv.read_tsv(spark, path), tsv.SOURCE)), out)


def _sources(spark: SparkSession, paths: list[str], columns) -> DataFrame:
    """Normalised files as one table, with their number and the order of their lines."""
    all_ = None
    for i, path in enumerate(paths, 1):
        df = tsv.read_tsv(spark, path, columns).withColumns({"source": F.lit(i), "ord": F.monotonically_increasing_id()})
        all_ = df if all_ is None else all_.unionByName(df)
    return all_


def audit(spark: SparkSession, records: DataFrame, truth: DataFrame | None) -> None:
    entities.country_counts(records).orderBy("source", F.desc("n")).show(1000, truncate=False)
    entities.blank_counts(records).orderBy("source").show()
    if truth is not None:
        entities.country_mismatch(truth, records).show()
        entities.mismatch_examples(truth, records).show(truncate=False)


def block(spark: SparkSession, sources: list[str], out_long: str | None, out_wide: str | None, truth: str | None = None, audit_only: bool = False, dry_run: int | None = None, p: blocking.Blocking = blocking.Blocking()) -> None:
    records = materialize(_sources(spark, sources, BLOCKING_INPUT), "records")
    audit(spark, records, tsv.read_tsv(spark, truth, tsv.GROUND_TRUTH) if truth else None)
    if audit_only:
        return
    if dry_run:
        records = materialize(entities.dry_run(records, dry_run), "dry-run")
    pairs = materialize(blocking.candidates(records, p), "pairs")
    wide = blocking.to_wide(pairs, records.where("source = 1").select(F.col("entity_id").alias("source1_entity_id")))
    if out_long:
        tsv.write_tsv(pairs, out_long)
    if out_wide:
        tsv.write_tsv(wide, out_wide)
    model.list_counts(wide, "candidate_entity_ids").show()


def make_features(spark: SparkSession, pairs: str, sources: list[str], out: str, truth: str | None = None) -> None:
    candidates = tsv.read_tsv(spark, pairs, tsv.CANDIDATES_LONG[:2])
    records = materialize(_sources(spark, sources, LOOKUP_INPUT), "records")
    given = tsv.read_tsv(spark, truth, tsv.GROUND_TRUTH) if truth else None
    tsv.write_tsv(features.feature_rows(candidates, records, given), out)


def _feature_table(spark: SparkSession, path: str, labelled: bool) -> DataFrame:
    numeric = {f: "double" for f in features.FEATURES} | ({"label": "int"} if labelled else {})
    return tsv.read_tsv(spark, path, ("source1_entity_id", "candidate_entity_id", *numeric), numeric=numeric)


def train(spark: SparkSession, path: str, model_dir: str, threshold: str, **options) -> dict:
    rows = materialize(_feature_table(spark, path, True), "features")
    held = model.in_validation(F.col("source1_entity_id"))
    fitted = model.fit(rows.where(~held), **options)
    model.save(fitted, model_dir)
    scored = materialize(model.predict_proba(fitted, rows.where(held)).select("source1_entity_id", "candidate_entity_id", "label", "prob"), "validation")
    best = model.best_threshold(model.sweep(scored)).first()
    out = {"threshold": best.threshold, "val_f0_5": best.macro_f} if best else {"threshold": 0.5, "val_f0_5": -1.0}
    tsv.write_json_row(spark, threshold, **out)
    return out


def predict(spark: SparkSession, path: str, candidates: str, model_dir: str, threshold: str, out: str, out_candidates: str | None = None) -> None:
    """Match lists in the order of the candidates' lists, which pass through to ``out_candidates``."""
    scored = model.predict_proba(model.load(model_dir), _feature_table(spark, path, False))
    ids = tsv.read_tsv(spark, candidates, tsv.CANDIDATES_WIDE)
    # A list is in the order of the blocking score; what it lacks comes last.
    place = F.array_position(F.split("candidate_entity_ids", ","), F.col("candidate_entity_id"))
    scored = scored.join(ids, "source1_entity_id").withColumn("_order", -F.when(place > 0, place).otherwise(1 << 30))
    lists = model.match_lists(scored, ids, tsv.read_json_row(spark, threshold)["threshold"], order_col="_order")
    tsv.write_tsv(lists, out)
    if out_candidates:
        tsv.write_tsv(ids, out_candidates)
    model.list_counts(tsv.read_tsv(spark, out), "matched_entity_ids").show()


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="tessera")
    sub = top.add_subparsers(dest="what", required=True)
    a = sub.add_parser("normalize")
    a.add_argument("path")
    a.add_argument("out")
    a = sub.add_parser("block")
    for s in ("--s1", "--s2", "--s3"):
        a.add_argument(s, required=True)
    for s in ("--out-long", "--out-wide", "--ground-truth"):
        a.add_argument(s)
    a.add_argument("--audit-only", action="store_true")
    a.add_argument("--dry-run", type=int)
    a.add_argument("--k", type=int, default=20)
    a.add_argument("--sim-floor", type=float, default=0.3)
    a.add_argument("--max-candidates-per-doc", type=int, default=300)
    a = sub.add_parser("features")
    a.add_argument("--pairs", required=True)
    a.add_argument("--sources", nargs="+", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--ground-truth")
    a = sub.add_parser("train")
    for s in ("--features", "--model", "--threshold"):
        a.add_argument(s, required=True)
    a.add_argument("--trees", type=int, default=200)
    a = sub.add_parser("predict")
    for s in ("--features", "--candidates", "--model", "--threshold", "--out"):
        a.add_argument(s, required=True)
    a.add_argument("--out-candidates")
    o = top.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if o.what == "normalize":
        normalize_file(spark, o.path, o.out)
    elif o.what == "block":
        block(spark, [o.s1, o.s2, o.s3], o.out_long, o.out_wide, o.ground_truth, o.audit_only, o.dry_run, blocking.Blocking(k=o.k, sim_floor=o.sim_floor, max_candidates=o.max_candidates_per_doc))
    elif o.what == "features":
        make_features(spark, o.pairs, o.sources, o.out, o.ground_truth)
    elif o.what == "train":
        print(train(spark, o.features, o.model, o.threshold, max_iter=o.trees))
    else:
        predict(spark, o.features, o.candidates, o.model, o.threshold, o.out, o.out_candidates)


if __name__ == "__main__":
    main()
