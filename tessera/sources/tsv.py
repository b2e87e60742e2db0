"""Tab-separated tables with a header, as every stage reads and writes them.

Paths are Hadoop paths: local, ``s3a://`` or any other store that Spark reads,
so nothing is downloaded or cached by name first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings that stand for a missing value, beside blank.
NULL_SENTINELS = (
    "NA", "N/A", "n/a", "NULL", "null", "None", "nan", "NaN", "<NA>", "#N/A", "#NA", "#N/A N/A",
    "-NaN", "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN",
)

SOURCE = ("entity_id", "business_name", "business_address", "country")
GROUND_TRUTH = ("source1_entity_id", "matched_entity_ids")
CANDIDATES_LONG = ("source1_entity_id", "candidate_entity_id", "blocking_score")
CANDIDATES_WIDE = ("source1_entity_id", "candidate_entity_ids")


def require(df: DataFrame, columns) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def fill_blank(df: DataFrame, null_sentinels=NULL_SENTINELS) -> DataFrame:
    """Null and the sentinels to blank, in string columns."""
    return df.select(*[F.when(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").isin(*null_sentinels), "").otherwise(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', inferSchema=False, enforceSchema=False).columns


def read_tsv(spark: SparkSession, path: str, columns=None, null_sentinels=NULL_SENTINELS, numeric: dict[str, str] | None = None) -> DataFrame:
    """All columns as strings, ids included, but for ``numeric`` ones (name to type).

    ``columns`` are required and projected; the parser then skips the others.
    """
    numeric = numeric or {}
    names = header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = spark.read.schema(schema).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if columns is not None:
        df = require(df, columns).select(*columns)
    df = fill_blank(df, null_sentinels)
    return df.select(*[F.expr(f"try_cast(`{c}` AS {numeric[c]})").alias(c) if c in numeric else F.col(f"`{c}`") for c in df.columns])


def write_tsv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite ``path``; arrays are written as comma-joined strings, booleans as True and False."""
    cols = []
    for c, t in df.dtypes:
        x = F.col(f"`{c}`")
        if t.startswith("array"):
            x = F.array_join(x, ",")
        elif t == "boolean":
            x = F.initcap(x.cast("string"))
        cols.append(x.alias(c))
    writer = df.select(*cols).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_json_row(spark: SparkSession, path: str, **values) -> None:
    """A one-row JSON table, such as the threshold."""
    spark.range(1, numPartitions=1).select(*[F.lit(v).alias(k) for k, v in values.items()]).write.mode("overwrite").json(path)


def read_json_row(spark: SparkSession, path: str) -> dict:
    return spark.read.json(path).first().asDict()
