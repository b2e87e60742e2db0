"""Line deduplication over levelled sorted runs of line hashes.

Every batch of documents contributes one immutable run: a row for each line
key, sorted by its 128-bit hash, with the number of documents that hold the
line. Runs are dealt to the same buckets by hash, so a batch is dealt once and
merged with each run without moving the run. What the merge anti-join with the
runs leaves of a batch is new: only these rows name the document that keeps the
line, the largest of the batch. ``fanout`` runs of a level are merged into one
run of the next level, so that a key is looked up in few runs.

A table is dealt to the runs from its highest ids down. The document that
first brought a line is then the largest one that holds it, and all others
lose it once the runs count enough of them.

Only DataFrame functions are used. The text itself is shuffled once, to meet
the positions that it loses; all else that moves is hashes and ids.

Defined results: a null or empty text is one empty line. Lines are compared by
their key: blanks stripped at both ends and A-Z lower-cased. Rows that share a
doc_id count as one document. A row without doc_id keeps all its lines and
counts for no line. An empty table gives an empty result. Other columns of the
input are left alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.native import documents, lower_ascii, strip_blanks, text_or_empty
from tessera.workspace import drop_path, dropped_table, materialize, new_path, release

MIN_CHARS = 40
MIN_DOCS = 5


def _hashes(lines: Column, min_chars: int) -> Column:
    """For each line (position, h1, h2); the hashes are null for short keys."""

    def one(line: Column, pos: Column) -> Column:
        key = lower_ascii(strip_blanks(line))
        long = F.char_length(strip_blanks(line)) >= min_chars
        return F.struct(
            pos.alias("pos"),
            F.when(long, F.xxhash64(key)).alias("h1"),
            F.when(long, F.xxhash64(F.lit(1), key)).alias("h2"),
        )

    return F.transform(lines, one)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, pos, h1, h2): a row for each line that is long enough to repeat."""
    text = text_or_empty(F.col(f"`{text_col}`"))
    return (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("t"))
        .where("doc_id is not null")
        .select("doc_id", F.xxhash64("t").alias("th"), F.inline(F.filter(_hashes(F.split("t", "\n", -1), min_chars), lambda x: x["h1"].isNotNull())))
    )


class LineRuns:
    """The levelled runs: ``levels[i]`` holds the tables of the runs of level i, each (h1, h2, n_docs, keeper).

    ``keeper`` is set in the one run that first held the line.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int = 0):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame, level: int) -> None:
        path = new_path(self.spark, f"line-run-{level}")
        name = "run_" + path.rsplit("/", 2)[1].replace("-", "_") + "_" + path.rsplit("/", 1)[1].replace("-", "_")
        dealt = rows.repartition(self.buckets, "h1").sortWithinPartitions("h1", "h2")
        dealt.write.option("compression", "zstd").option("path", path).bucketBy(self.buckets, "h1").sortBy("h1", "h2").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def known(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``old``: whether a run holds the key."""
        out = keys.withColumn("old", F.lit(False))
        for run in self._tables():
            has = run.select("h1", "h2", F.lit(True).alias("_has")).hint("merge")
            out = out.join(has, ["h1", "h2"], "left").withColumn("old", F.col("old") | F.col("_has").isNotNull()).drop("_has")
        return out

    def add(self, lines: DataFrame) -> None:
        """Anti-join a batch with the runs and add its own run. Batches must not share documents."""
        keys = lines.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("top"))
        run = self.known(keys).select("h1", "h2", "n_docs", F.when(~F.col("old"), F.col("top")).alias("keeper"))
        self._write(run, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        # Read as plain files: a union of bucketed tables is taken for dealt by key, but is not.
        rows = self.spark.read.schema("h1 long, h2 long, n_docs long, keeper long").parquet(*[path for _, path in runs])
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def compact(self, level: int) -> None:
        old, self.levels[level] = self.levels[level], []
        self._write(self._merged(old), level + 1)
        self._drop(old)

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            dropped_table(self.spark, name)
            drop_path(self.spark, path)

    def drop(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = [[]]

    def repeated(self, min_docs: int) -> DataFrame:
        """(h1, h2, keeper), written: the lines of at least so many documents."""
        found = self._merged([r for level in self.levels for r in level]).where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
        return materialize(found, "repeated-lines")


def repeated_positions(lines: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, th, gone): the positions that each row of a batch loses.

    The inner join reads two written tables, so that Spark splits the partition
    of a line that a third of all documents hold.
    """
    met = lines.join(runs.repeated(min_docs), ["h1", "h2"]).where(F.col("doc_id") != F.col("keeper"))
    return met.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, positions: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """All columns of ``docs`` with ``text_col`` rewritten; ``counts`` names columns for the lines and the dropped ones."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("_row")).select("_row", F.col(f"_row.`{id_col}`").cast("long").alias("_id"), text_or_empty(F.col(f"_row.`{text_col}`")).alias("_t"))
    keyed = keyed.withColumn("_th", F.xxhash64("_t"))
    gone = positions.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "gone")
    lines = F.split("_t", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("gone"))
    kept_text = F.when(F.col("gone").isNull(), F.col("_t")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n"))
    out = keyed.join(gone.hint("merge"), ["_id", "_th"], "left").withColumn("_lines", lines)
    numbers = [F.size("_lines").cast("long"), F.coalesce(F.size("gone"), F.lit(0)).cast("long")]
    added = [n.alias(c) for n, c in zip(numbers, counts or ())]
    kept_cols = [c for c in docs.columns if c not in (counts or ())]
    return out.select(*[(kept_text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in kept_cols], *added)


def _edges(docs: DataFrame, key: Column, batches: int) -> list[int]:
    """Ids that part a table in about equal batches."""
    if batches < 2:
        return []
    found = docs.select(F.percentile_approx(key, [i / batches for i in range(1, batches)], 10000).alias("e")).first().e
    return sorted(set(found or []))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = 5, fanout: int = 4, counts: tuple[str, str] | None = None) -> DataFrame:
    """Deduplicate a whole table: its batches enter the runs from the highest ids down."""
    spark = docs.sparkSession
    edges = _edges(docs, F.col(f"`{id_col}`").cast("long"), batches)
    batch = F.lit(0)
    for e in edges:  # a batch ends at each edge
        batch = batch + F.when(F.col("doc_id") > e, 1).otherwise(0)
    lines = materialize(line_table(docs, id_col, text_col, min_chars).withColumn("batch", batch), "lines", "batch")
    runs = LineRuns(spark, fanout)
    for b in range(len(edges), -1, -1):
        runs.add(lines.where(F.col("batch") == b).select("h1", "h2", "doc_id"))
    positions = materialize(repeated_positions(lines.drop("batch"), runs, min_docs), "line-positions")
    release(lines)
    runs.drop()
    return drop_repeated_lines(docs, positions, id_col, text_col, counts)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
hot AS (
  SELECT k, max(doc_id) AS max_doc FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.pos, l.line, h.k IS NOT NULL AND l.doc_id < h.max_doc AS gone
  FROM lines l LEFT JOIN hot h ON l.k = h.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
