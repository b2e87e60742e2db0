"""The driver's tables as sources of the linkage pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.entities import normalize_entities


#: What stands before the ninth word; its group is the first eight words.
_FIRST = r"^\s*+((?:\S++\s++){0,7}\S++)"


def _spaced(c: Column) -> Column:
    """Words joined by single spaces, as :func:`tessera.functions.tokens.tokens` cuts them."""
    return F.trim(F.regexp_replace(c, r"\s{2,}|[\t\n\x0b\f\r]", " "))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a record of source 1, 2 or 3, by the number in its source.

    Its name is the first eight words and its address all others, so that the
    two hold the whole text; its country is the language.
    """
    text = F.coalesce("text", F.lit(""))
    rest = F.substring(text, F.char_length(F.regexp_extract(text, _FIRST, 0)) + 1, F.char_length(text))
    number = F.substring("source", 4, 9).cast("int")
    return documents(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("entity_id"),
        _spaced(F.regexp_extract(text, _FIRST, 1)).alias("business_name"),
        _spaced(rest).alias("business_address"),
        F.col("lang").alias("country"),
        F.when(number < 8, 1).when(number < 14, 2).otherwise(3).alias("source"),
        F.col("doc_id").alias("ord"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_entities(source_records(spark, sf_dir))


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists of the source-2 and -3 records whose whole text equals that of a source-1 record."""
    docs = documents(spark, sf_dir).where("text is not null").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.substring("source", 4, 9).cast("int").alias("number"), F.sha2("text", 256).alias("h"))
    a = docs.where("number < 8").select(F.col("id").alias("source1_entity_id"), "h")
    b = docs.where("number >= 8").select(F.col("id").alias("other"), "h")
    return a.join(b, "h").groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_list("other")), ",").alias("matched_entity_ids"))


def customers_and_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as source 1 and suppliers as source 2, country being the nation's number."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entity_id"), F.col("c_name").alias("business_name"), F.col("c_nationkey").cast("string").alias("country"), F.lit(1).alias("source"), F.col("c_custkey").alias("ord"))
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("entity_id"), F.col("s_name").alias("business_name"), F.col("s_nationkey").cast("string").alias("country"), F.lit(2).alias("source"), F.col("s_suppkey").alias("ord"))
    both = c.unionByName(s).withColumn("business_address", F.lit(""))
    return normalize_entities(both)


def numbered_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and supplier of one number, whatever their nations."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("n"))
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("n"))
    return c.join(s, "n").select(F.concat(F.lit("c"), F.col("n").cast("string")).alias("source1_entity_id"), F.concat(F.lit("s"), F.col("n").cast("string")).alias("matched_entity_ids"))
