"""Column expressions that several corpus operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the corpus contracts, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def strip_blanks(col: Column) -> Column:
    return F.trim(col, F.lit(BLANKS))


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` does that to pure ASCII, and faster."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, string.ascii_uppercase, string.ascii_lowercase)
    )


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small reference table from literals; ``rows`` must not be empty."""
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])))
