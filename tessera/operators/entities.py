"""Source records to normalised entities, and the country audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.sources.tsv import SOURCE, require


def normalize_entities(df: DataFrame, latin_only: bool = False) -> DataFrame:
    """The input with clean name, address and country, and whether any field was transliterated."""
    require(df, SOURCE)
    return df.withColumns(
        {
            "business_name_clean": text.normalize(F.col("business_name"), text.GENERAL, latin_only),
            "business_address_clean": text.normalize(F.col("business_address"), text.ADDRESS, latin_only),
            "country_clean": text.normalize_country(F.col("country")),
            "was_transliterated": text.is_non_latin(F.col("business_name")) | text.is_non_latin(F.col("business_address")),
        }
    )


def has_unique_ids(entities: DataFrame) -> bool:
    """Whether every record has an id of its own."""
    return entities.groupBy("entity_id").count().where("count > 1 or entity_id is null").isEmpty()


def country_counts(entities: DataFrame) -> DataFrame:
    """(source, country_clean, n) over entities with a ``source`` number."""
    return entities.groupBy("source", "country_clean").agg(F.count("*").alias("n"))


def blank_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("source").agg(F.count_if(F.col("country_clean") == "").alias("n_blank"), F.count("*").alias("n"))


def explode_truth(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_id) from comma lists; blank lists give no rows."""
    given = truth.where(F.coalesce("matched_entity_ids", F.lit("")) != "")
    ids = F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x))
    return given.select("source1_entity_id", F.explode(ids).alias("candidate_entity_id"))


def truth_countries(truth: DataFrame, entities: DataFrame) -> DataFrame:
    """True pairs with both countries; an unknown id has a null one."""
    pairs = explode_truth(truth)
    known = entities.groupBy("entity_id").agg(F.max("country_clean").alias("country_clean"))
    a = known.select(F.col("entity_id").alias("source1_entity_id"), F.col("country_clean").alias("s1_country"))
    b = known.select(F.col("entity_id").alias("candidate_entity_id"), F.col("country_clean").alias("match_country"))
    return pairs.join(a, "source1_entity_id", "left").join(b, "candidate_entity_id", "left").select("source1_entity_id", "s1_country", "candidate_entity_id", "match_country")


def country_mismatch(truth: DataFrame, entities: DataFrame, warn_above: float = 2.0) -> DataFrame:
    """One row: pairs, those whose countries differ (two unknown ones do not), the share, and whether it warns."""
    pairs = truth_countries(truth, entities)
    differ = ~F.col("s1_country").eqNullSafe(F.col("match_country"))
    out = pairs.agg(F.count_if(differ).alias("mismatches"), F.count("*").alias("total_pairs"))
    pct = F.coalesce(F.try_divide(100.0 * F.col("mismatches"), F.col("total_pairs")), F.lit(0.0))
    return out.select("mismatches", "total_pairs", F.round(pct, 6).alias("pct"), (pct > warn_above).alias("warn"))


def mismatch_examples(truth: DataFrame, entities: DataFrame, n: int = 10) -> DataFrame:
    differ = ~F.col("s1_country").eqNullSafe(F.col("match_country"))
    return truth_countries(truth, entities).where(differ).orderBy("source1_entity_id", "candidate_entity_id").limit(n)


def dry_run(entities: DataFrame, n: int) -> DataFrame:
    """The first n rows of source 1 and the first 10 n of each other source, by ``ord``."""
    per = F.when(F.col("source") == 1, n).otherwise(10 * n)
    rank = F.row_number().over(Window.partitionBy("source").orderBy("ord", "entity_id"))
    return entities.withColumn("_rank", rank).where(F.col("_rank") <= 10 * n).where(F.col("_rank") <= per).drop("_rank")


def referenced_ids(pairs: DataFrame) -> DataFrame:
    """Distinct entity ids on either side of candidate pairs."""
    return pairs.select(F.col("source1_entity_id").alias("entity_id")).union(pairs.select("candidate_entity_id")).distinct()


def needed_entities(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities that any pair refers to."""
    return entities.join(referenced_ids(pairs), "entity_id", "left_semi")
