"""The registered queries of the linkage pipeline, each over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import similarity, text, tokens
from tessera.operators import blocking, entities, features, model
from tessera.plans import fixtures
from tessera.sources import tsv
from tessera.workspace import materialize, new_path

ROUND = 6
KEYS = ("source1_entity_id", "candidate_entity_id")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return reduce(lambda d, c: d.withColumn(c, F.round(c, ROUND)), cols, df)


def _entities(spark: SparkSession, sf: str, addresses: bool = False) -> DataFrame:
    """Entities as a written table, as normalisation is read several times; with addresses where they are looked at."""
    e = fixtures.entities(spark, sf).drop("business_name", "business_address", "country")
    return materialize(e if addresses else e.drop("business_address_clean"), "entities")


def _both(spark: SparkSession, sf: str, addresses: bool = False, p: blocking.Blocking = blocking.Blocking()) -> tuple[DataFrame, DataFrame]:
    """Entities and the candidates."""
    e = _entities(spark, sf, addresses)
    return e, blocking.candidates(e, p)


def _labelled(spark: SparkSession, sf: str, p: blocking.Blocking = blocking.Blocking()) -> DataFrame:
    """Candidates with a label, and their score as the probability."""
    e, topk = _both(spark, sf, p=p)
    return features.label(topk, fixtures.ground_truth(spark, sf)).withColumn("prob", F.col("blocking_score"))


def _s1(e: DataFrame) -> DataFrame:
    return e.where("source = 1").select(F.col("entity_id").alias("source1_entity_id"))


def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).select("doc_id", text.normalize(F.col("text"), text.GENERAL).alias("clean"))


def normalize_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).select("doc_id", text.normalize(F.col("text"), text.ADDRESS).alias("clean"))


def normalize_country(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).select("doc_id", text.normalize_country(F.col("lang")).alias("country_clean"), text.is_non_latin(F.col("text")).alias("was_transliterated"))


def country_counts(spark: SparkSession, sf: str) -> DataFrame:
    return entities.country_counts(fixtures.entities(spark, sf))


def country_blank_counts(spark: SparkSession, sf: str) -> DataFrame:
    return entities.blank_counts(fixtures.entities(spark, sf))


def gt_country_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return entities.country_mismatch(fixtures.numbered_truth(spark, sf), fixtures.customers_and_suppliers(spark, sf))


def gt_mismatch_examples(spark: SparkSession, sf: str) -> DataFrame:
    return entities.mismatch_examples(fixtures.numbered_truth(spark, sf), fixtures.customers_and_suppliers(spark, sf))


def token_df(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.document_frequency(fixtures.entities(spark, sf).where("source <> 1"))


def common_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.common_tokens(fixtures.entities(spark, sf).where("source <> 1"))


def blocking_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = _entities(spark, sf)
    return blocking.blocking_pairs(e.where("source = 1"), e.where("source <> 1"))


def name_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.capped_scores(_entities(spark, sf))


def blocking_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, p=blocking.WHOLE)[1]


def _wide(spark: SparkSession, sf: str, p: blocking.Blocking = blocking.Blocking()) -> DataFrame:
    e, topk = _both(spark, sf, p=p)
    return blocking.to_wide(topk, _s1(e))


def candidates_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf)


def candidate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return model.list_counts(_wide(spark, sf, blocking.WHOLE), "candidate_entity_ids")


def blocking_recall(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.recall(_both(spark, sf)[1], entities.explode_truth(fixtures.ground_truth(spark, sf)))


def char_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    return features.gram_counts(fixtures.entities(spark, sf))


def gt_explode(spark: SparkSession, sf: str) -> DataFrame:
    return entities.explode_truth(fixtures.ground_truth(spark, sf))


def needed_entities(spark: SparkSession, sf: str) -> DataFrame:
    e, topk = _both(spark, sf, True)
    return entities.needed_entities(topk, e).select("entity_id", "business_name_clean", "business_address_clean", "country_clean")


def dedupe_union(spark: SparkSession, sf: str) -> DataFrame:
    return entities.referenced_ids(materialize(_both(spark, sf)[1], "topk"))


def label_join(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select(*KEYS, "label")


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(model.class_weights(materialize(_labelled(spark, sf, blocking.WHOLE), "labelled")), "weight")


def _met(spark: SparkSession, sf: str, column: str, p: blocking.Blocking = blocking.Blocking()) -> DataFrame:
    """Candidates with a column of both sides."""
    e, topk = _both(spark, sf, column == "business_address_clean", p)
    return features._sides(topk.select(*KEYS), e.select("entity_id", column))


def _jaccard(met: DataFrame, column: str, out: str) -> DataFrame:
    a, b = (tokens.tokens(F.col(f"{side}_{column}")) for side in ("s1", "cand"))
    return _rounded(met.select(*KEYS, similarity.jaccard(a, b).alias(out)), out)


def name_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return _jaccard(_met(spark, sf, "business_name_clean", blocking.WHOLE), "business_name_clean", "name_token_jaccard")


def _addresses(spark: SparkSession, sf: str, out: str) -> DataFrame:
    """Candidates with a feature of their addresses; ids that repeat are joined row by row."""
    if not entities.has_unique_ids(fixtures.source_records(spark, sf)):
        met = _met(spark, sf, "business_address_clean")
        if out == "address_token_jaccard":
            return _jaccard(met, "business_address_clean", out)
        return _rounded(met.select(*KEYS, similarity.seq_ratio("s1_business_address_clean", "cand_business_address_clean").alias(out)), out)
    e, topk = _both(spark, sf, True)
    return _rounded(features.address_features(materialize(topk, "topk"), e, out == "address_seq_ratio").select(*KEYS, out), out)


def addr_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return _addresses(spark, sf, "address_token_jaccard")


def flag_features(spark: SparkSession, sf: str) -> DataFrame:
    e, topk = _both(spark, sf)
    return features.flags(topk.select(*KEYS), e.withColumn("business_address_clean", F.lit("")))


def seq_ratio(spark: SparkSession, sf: str) -> DataFrame:
    met = _met(spark, sf, "business_name_clean")
    return _rounded(met.select(*KEYS, similarity.seq_ratio("s1_business_name_clean", "cand_business_name_clean").alias("name_seq_ratio")), "name_seq_ratio")


def address_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """The same of the addresses, which are the rest of whole texts: too long for SQL."""
    return _addresses(spark, sf, "address_seq_ratio")


def quick_ratio(spark: SparkSession, sf: str) -> DataFrame:
    met = _met(spark, sf, "business_name_clean").select(*KEYS, similarity.quick_ratio(F.col("s1_business_name_clean"), F.col("cand_business_name_clean")).alias("quick_ratio"))
    return _rounded(met, "quick_ratio")


def tfidf_idf(spark: SparkSession, sf: str) -> DataFrame:
    e, topk = _both(spark, sf)
    return _rounded(features.fit_idf(entities.needed_entities(materialize(topk, "topk"), e)), "idf")


def tfidf_cosine(spark: SparkSession, sf: str) -> DataFrame:
    e, topk = _both(spark, sf)
    topk = materialize(topk, "topk").select(*KEYS)
    idf = features.fit_idf(entities.needed_entities(topk, e))
    if not entities.has_unique_ids(e):
        return _rounded(features.tfidf_cosine(topk, features.tfidf_vectors(entities.needed_entities(topk, e), idf)), "name_tfidf_cosine")
    return _rounded(features.name_cosines(topk, e, idf), "name_tfidf_cosine")


def feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    e, topk = _both(spark, sf, True)
    rows = features.feature_rows(materialize(topk, "topk"), e, fixtures.ground_truth(spark, sf))
    return _rounded(rows, "name_token_jaccard", "name_seq_ratio", "name_tfidf_cosine", "address_token_jaccard", "address_seq_ratio")


def group_split(spark: SparkSession, sf: str) -> DataFrame:
    s1 = fixtures.source_records(spark, sf).where("source = 1")
    return s1.select("entity_id", model.in_validation(F.col("entity_id")).alias("validation"))


def macro_f05(spark: SparkSession, sf: str) -> DataFrame:
    return model.macro_f_beta(_labelled(spark, sf).withColumn("predicted", (F.col("prob") >= 0.5).cast("int")))


def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return model.sweep(_labelled(spark, sf))


def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return model.best_threshold(threshold_sweep(spark, sf))


def match_lists(spark: SparkSession, sf: str) -> DataFrame:
    e, topk = _both(spark, sf)
    return model.match_lists(topk, _s1(e), 0.5, "blocking_score")


def dry_run_limit(spark: SparkSession, sf: str) -> DataFrame:
    return entities.dry_run(fixtures.source_records(spark, sf), 20).select("entity_id", "source")


def gbt_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the entities outside validation, then give every pair its probability."""
    e, topk = _both(spark, sf, True)
    rows = materialize(features.feature_rows(materialize(topk, "topk"), e, fixtures.ground_truth(spark, sf)), "feature-rows")
    fitted = model.fit(rows.where(~model.in_validation(F.col("source1_entity_id"))))
    return model.predict_proba(fitted, rows).select(*KEYS, "label", "prob")


def tsv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Source records written partitioned by country and read again."""
    path = new_path(spark, "records.tsv")
    tsv.write_tsv(fixtures.source_records(spark, sf).drop("ord", "source").withColumn("part", F.col("country")), path, "part")
    return tsv.read_tsv(spark, path, tsv.SOURCE)


QUERIES = {f.__name__: f for f in (
    normalize_names, normalize_addresses, normalize_country, country_counts, country_blank_counts, gt_country_mismatch,
    gt_mismatch_examples, token_df, common_tokens, blocking_pairs, name_cosine, blocking_topk, candidates_wide,
    candidate_counts, blocking_recall, char_ngrams, gt_explode, needed_entities, dedupe_union, label_join, label_counts,
    name_jaccard, addr_jaccard, flag_features, seq_ratio, address_ratio, quick_ratio, tfidf_idf, tfidf_cosine, feature_rows, group_split,
    macro_f05, threshold_sweep, best_threshold, match_lists, dry_run_limit, gbt_predict, tsv_round_trip,
)}
