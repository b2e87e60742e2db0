"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

The longest pieces open as many sequences as all tokens need at least, or one
for each piece that is longer than half a sequence. Then rounds follow until
every piece has a place. In a round

1. the pieces left and the gaps of open sequences are range-sorted together by
   size;
2. each partition is swept upward: a gap takes the longest piece left under it,
   which is the piece whose successor it is once conflicts are resolved by rank,
   as closing brackets take opening ones;
3. what a sweep left over, gaps without a piece below them and pieces without a
   gap above them, meets over partitions by the same rule: from their counts,
   one row for each partition, follows which ranks take which;
4. the gaps are updated.

While there are more pieces than gaps, a gap is offered as several slots of
equal size, so the number of rounds grows with the logarithm of the pieces of
a sequence. Pieces longer than every gap open new sequences, as many as their
tokens need.

All is tables of (key, length) and (sequence, gap); texts are read once. What
reaches the driver are the counts of lengths, at most the capacity, and counts
for each partition. A sequence holds at most ``capacity`` pieces.

Defined results: a null or empty text is its end id alone. A text longer than
the capacity is cut into whole sequences, its first piece the shorter one.
Rows that share a doc_id are packed each, as are rows without one. An empty
table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.encoding import default_tokenizer, encoder, text_slices
from tessera.llm.hashing import settle
from tessera.llm.native import documents, text_or_empty
from tessera.workspace import materialize, release

CAPACITY = 2048
END_ID = 0
#: key: the partition that cut a piece, and its rank there; unique once the pieces are written.
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, key long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document."""
    end = np.array([end_id], np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, key = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            docs_ = batch.column(0).to_pylist()
            for a, texts in text_slices(batch.column(1)):
                rows: list[tuple] = []
                for doc, ids in zip(docs_[a : a + len(texts)], enc.encode(texts)):
                    ids = np.append(ids, end).astype("<u4")
                    n = len(ids)
                    start, piece = 0, 0
                    while start < n:
                        length = (n - start) % capacity or capacity
                        rows.append((doc, piece, start, length, zlib.crc32(ids[start : start + length]), key))
                        key += 1
                        start, piece = start + length, piece + 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32", "key"])
        settle()

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text")).mapInArrow(cut, PIECES)


def seeds(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, length, seed): whether a piece opens a sequence; written. Of equals at the border the first by key do."""
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    tokens, long = sum(x * n for x, n in counts.items()), sum(n for x, n in counts.items() if 2 * x > capacity)
    wanted, border = max(long, -(-tokens // capacity)), 0
    for border in sorted(counts, reverse=True):
        if counts[border] >= wanted:
            break
        wanted -= counts[border]
    # Those of the border's length are numbered over the partitions that cut them.
    part = F.shiftright("key", 40)
    equal = pieces.where(F.col("length") == border).select(F.col("key").alias("k"), part.alias("part"))
    sizes = equal.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("k"))
    chosen = equal.join(F.broadcast(before), "part").withColumn("place", place).where(F.col("place") <= wanted).select("k", F.lit(True).alias("first"))
    met = pieces.join(chosen.hint("merge"), pieces.key == F.col("k"), "left")
    return materialize(met.select("key", "length", (F.col("first").isNotNull() | (F.col("length") > border)).alias("seed")), "seeds")


#: what: 0 a match of a piece and a sequence, 1 a piece left over, 2 a slot left over; rank: its place among those of its partition.
SWEPT = "what int, part int, rank long, key long, length long, seq long"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (size, kind, id) in order, pieces (kind 0) before slots of their size."""
    part, stack, matched, alone = TaskContext.get().partitionId(), [], [], []

    def rows(what: int, found: list[tuple]) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(found), 50_000):
            some = found[lo : lo + 50_000]
            key, length, seq = zip(*some)
            n = len(some)
            cols = [np.full(n, what, np.int32), np.full(n, part, np.int32), np.arange(lo, lo + n), np.array(key, np.int64), np.array(length, np.int64), np.array(seq, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["what", "part", "rank", "key", "length", "seq"])

    for batch in batches:
        for size, kind, id_ in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                stack.append((id_, size))
            elif stack:
                matched.append((*stack.pop(), id_))
            else:
                alone.append((0, size, id_))
        yield from rows(0, matched)
        matched = []
    yield from rows(1, [(key, size, 0) for key, size in reversed(stack)])
    yield from rows(2, alone)


def _meet(counts: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int, int]]:
    """Which leftovers of partitions match: (slots' partition, first rank, pieces' partition, first rank, number)."""
    waiting, out = [], []
    for part in sorted({p for p, _ in counts}):
        rank, slots = 0, counts.get((part, 2), 0)
        while slots and waiting:
            below, first, n = waiting.pop()
            some = min(n, slots)
            out.append((part, rank, below, first, some))
            rank, slots = rank + some, slots - some
            if n > some:
                waiting.append((below, first + some, n - some))
        if counts.get((part, 1)):
            waiting.append((part, 0, counts[part, 1]))
    return out


def sweep_round(free: DataFrame, gaps: DataFrame, offered: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(key, length, seq) of the pieces that found a gap, and (key, length) of the others; both written."""
    spark = free.sparkSession
    n = F.least(F.lit(offered), F.greatest(F.lit(1), F.floor(F.col("gap") / longest))).cast("int")
    slots = gaps.withColumn("n", n).select(F.floor(F.col("gap") / F.col("n")).alias("size"), F.lit(1).alias("kind"), F.explode(F.array_repeat("seq", F.col("n"))).alias("id"))
    rows = free.select(F.col("length").alias("size"), F.lit(0).alias("kind"), F.col("key").alias("id")).union(slots)
    swept = materialize(rows.repartitionByRange("size", "kind", "id").sortWithinPartitions("size", "kind", "id").mapInArrow(_sweep, SWEPT), "swept")
    left = swept.where("what > 0")
    counts = {(r.part, r.what): r["count"] for r in left.groupBy("part", "what").count().collect()}
    runs = [(i, *x) for i, x in enumerate(_meet(counts))]
    table = spark.createDataFrame(pa.table({c: pa.array([x[k] for x in runs], pa.int64()) for k, c in enumerate(["run", "slots", "from_slot", "pieces", "from_piece", "n"])}))

    def side(what: int, part: str, first: str) -> DataFrame:
        of = left.where(F.col("what") == what).join(F.broadcast(table), F.col("part") == F.col(part))
        place = F.col("rank") - F.col(first)
        return of.where((place >= 0) & (place < F.col("n"))).withColumn("place", place)

    met = side(1, "pieces", "from_piece").select("run", "place", "key", "length").join(side(2, "slots", "from_slot").select("run", "place", "seq"), ["run", "place"])
    placed = materialize(swept.where("what = 0").select("key", "length", "seq").union(met.select("key", "length", "seq")), "placed")
    rest = left.where("what = 1").select("key", "length").join(placed.select("key"), "key", "left_anti")
    rest = materialize(rest, "left")
    release(swept)
    return placed, rest


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece its sequence and offset. ``pieces`` must be a written table: it is read several times."""
    spark = pieces.sparkSession
    chosen = seeds(pieces, capacity)
    # A sequence is named by the piece that opened it; later ones count down from -1.
    done = [chosen.where("seed").select("key", F.col("key").alias("seq"), F.lit(0).alias("round"))]
    gaps = chosen.where("seed").select(F.col("key").alias("seq"), (capacity - F.col("length")).alias("gap"))
    gaps = materialize(gaps.where("gap > 0"), "gaps")
    free, opened = materialize(chosen.where("not seed").select("key", "length"), "free"), 0
    while True:
        size = free.agg(F.count("*").alias("n"), F.min("length").alias("least"), F.max("length").alias("most")).first()
        if not size.n:
            break
        largest = gaps.agg(F.max("gap")).first()[0] or 0
        if size.most > largest:
            more = -(-free.where(F.col("length") > largest).agg(F.sum("length")).first()[0] // capacity)
            gaps = gaps.union(spark.range(opened + 1, opened + more + 1).select((-F.col("id")).alias("seq"), F.lit(capacity).cast("long").alias("gap")))
            opened += more
        usable = gaps.where(F.col("gap") >= size.least)
        offered = max(1, size.n // max(1, usable.count()))
        placed, rest = sweep_round(free, usable, offered, size.most)
        taken = placed.groupBy("seq").agg(F.sum("length").alias("taken"))
        now = gaps.join(taken, "seq", "left").select("seq", (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap")).where("gap > 0")
        gaps = materialize(now, "gaps")
        release(free)
        free = rest
        done.append(placed.select("key", "seq", F.lit(len(done)).alias("round")))
    places = done[0]
    for more in done[1:]:
        places = places.union(more)
    met = pieces.join(places.hint("merge"), "key")
    offset = F.sum("length").over(Window.partitionBy("seq").orderBy("round", "key")) - F.col("length")
    return met.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), offset.alias("offset"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    pieces = materialize(cut_pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, id_col, text_col), "pieces")
    return place(pieces, capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
