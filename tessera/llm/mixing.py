"""Mixing sources to target weights by a hypergeometric splitting tree.

Each source is cut into ``BLOCKS`` blocks of documents by a keyed hash. How
many blocks the mix draws of each source follows from its target: every block
once for each whole time that the target holds the source, then blocks in a
permuted order up to the remainder, the last of them in part. These exact
quotas are parted among the output shards by a binary tree: at each node the
left half of the shards gets a multivariate-hypergeometric draw of the quotas,
the right half the rest. A shard takes the next blocks of the permuted order,
so shards are disjoint, and shuffles its documents locally by a hash.

The tree works on quotas of ``GROUPS`` groups of sources. Within a group all
draws stand in one permuted order, and the next ones of a random order are a
hypergeometric draw of its sources too, so the shares are the same as those of
a tree over sources. The top of the tree is parted at the driver, its subtrees
in tasks.

The data is never sorted or ranked as a whole, and there may be any number of
sources: sources, blocks and draws are tables. What reaches the driver is a
count for each group, and sums. A source with a third of all rows meets its
blocks, not one row, in the join.

Defined results: the size of a text is its number of words, 0 for null. A null
source is a source, the last in order. A source of size 0 gets target 0 and no
draws. Rows that share a doc_id, or have none, are drawn together with others
of that id and source. Reruns agree, as all draws come from ``seed`` and hashes
of the ids. An empty table gives no rows. Other columns pass through, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.native import documents, text_or_empty
from tessera.workspace import materialize, release

SEED = 17
#: Blocks of a source; groups of sources in the tree; subtrees that tasks part.
BLOCKS = 1024
GROUPS = 256
SUBTREES = 64
MAX_REPEAT = 3
#: Words of a shard, and the most partitions that shards are written in.
SHARD_WORDS = 1 << 21
PARTITIONS = 20_000
#: A table of blocks of up to this many rows, 300 bytes each at most, is broadcast.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cycle_weights(idx: Column) -> Column:
    return (idx % 3 + 1).cast("double")


def rank_sources(rows: DataFrame) -> DataFrame:
    """(source, source_size, idx), written: sources in order of code points, null last.

    Sources are ranged into partitions and numbered there; what goes over all
    of them is a row for each partition.
    """
    found = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    parts = materialize(found.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "ranged-sources")
    counts = parts.groupBy("pid").agg(F.count("*").alias("n"))
    before = counts.select("pid", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("pid").orderBy(*order)) - 1
    return materialize(parts.withColumn("place", place).join(F.broadcast(before), "pid").select("source", "source_size", (F.col("before") + F.col("place")).alias("idx")), "sources")


def water_fill(sources: DataFrame, weights: Callable[[Column], Column] = cycle_weights, most: float = MAX_REPEAT) -> DataFrame:
    """``sources`` with target: shares of the total by weight, none above ``most`` times its size; the excess is shared again.

    Below a level each source has its weight's share of it. The level rises as
    sources reach their bound; a round is one sum over the sources.
    """
    weight, bound = weights(F.col("idx")), F.lit(float(most)) * F.col("source_size")
    first = sources.agg(F.sum("source_size").alias("total"), F.sum(weight).alias("scale")).first()
    if not first.total:
        return sources.withColumn("target", F.lit(0.0))
    level, full = first.total / first.scale, -1
    while True:
        over = F.lit(level) * weight > bound
        now = sources.agg(F.sum(F.when(over, bound)).alias("held"), F.sum(F.when(~over, weight)).alias("scale"), F.count(F.when(over, 1)).alias("full")).first()
        if now.full == full or not now.scale:
            return sources.withColumn("target", F.when(over, bound).otherwise(F.lit(level) * weight))
        full, level = now.full, (first.total - (now.held or 0.0)) / now.scale


def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw; of populations that the generator does not take, its normal form."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    p = good / (good + bad)
    x = round(rng.normal(n * p, (n * p * (1 - p) * (good + bad - n) / (good + bad - 1)) ** 0.5))
    return min(max(x, n - bad, 0), good, n)


def _left(have: np.ndarray, lo: int, hi: int, seed: int) -> np.ndarray:
    """What the left half of a node's shards gets."""
    rng = np.random.default_rng([seed, lo, hi])
    rest, n = int(have.sum()), int(have.sum()) * ((lo + hi) // 2 - lo) // (hi - lo)
    out = np.zeros_like(have)
    for i, good in enumerate(have.tolist()):
        rest -= good
        out[i] = _draw(rng, good, rest, n)
        n -= int(out[i])
    return out


def split_node(lo: int, hi: int, have: np.ndarray, first: np.ndarray, seed: int, depth: int = -1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The nodes ``depth`` levels down, or the shards: (from, to, quotas, the quotas' first draws)."""
    if hi - lo == 1 or depth == 0:
        yield lo, hi, have, first
        return
    mid, left = (lo + hi) // 2, _left(have, lo, hi, seed)
    yield from split_node(lo, mid, left, first, seed, depth - 1)
    yield from split_node(mid, hi, have - left, first + left, seed, depth - 1)


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quotas of each shard: a (shards, groups) array that sums to ``quotas``."""
    quotas = np.asarray(quotas, np.int64)
    return np.stack([have for _, _, have, _ in split_node(0, shards, quotas, np.zeros_like(quotas), seed)])


def shard_ranges(spark: SparkSession, quotas: np.ndarray, shards: int, seed: int) -> DataFrame:
    """(grp, shard, first, n): the draws of a group's permuted order that a shard takes."""
    nodes = list(split_node(0, shards, quotas, np.zeros_like(quotas), seed, SUBTREES.bit_length() - 1))
    table = pa.table({"lo": pa.array([x[0] for x in nodes], pa.int64()), "hi": pa.array([x[1] for x in nodes], pa.int64()), "have": pa.array([x[2].tolist() for x in nodes], pa.list_(pa.int64())), "first": pa.array([x[3].tolist() for x in nodes], pa.list_(pa.int64()))})

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node in batch.to_pylist():
                for lo, _, have, first in split_node(node["lo"], node["hi"], np.array(node["have"], np.int64), np.array(node["first"], np.int64), seed):
                    some = np.flatnonzero(have)
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), lo)), pa.array(first[some]), pa.array(have[some])], ["grp", "shard", "first", "n"])

    return spark.createDataFrame(table).repartition("lo").mapInArrow(part, "grp long, shard long, first long, n long")


@dataclass
class MixPlan:
    """A row for each block: source, _block, source_size, target, draws: array of (shard, turn, upto)."""

    blocks: DataFrame
    n_blocks: int
    shards: int
    seed: int


def keyed(docs: DataFrame, seed: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(_row, _source, _size, _key): each row with what decides its draws."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_row"), F.col(f"`{source_col}`").cast("string").alias("_source"), word_count(text_or_empty(F.col(f"`{text_col}`"))).alias("_size"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("long")).alias("_key"))


def _block(blocks: int) -> Column:
    return F.pmod("_key", F.lit(blocks)).cast("int").alias("_block")


def plan_mix(rows: DataFrame, shards: int | None = None, seed: int = SEED, weights: Callable[[Column], Column] = cycle_weights, blocks: int | None = None) -> MixPlan:
    """The plan for rows of :func:`keyed`, which are read several times."""
    spark, blocks = rows.sparkSession, blocks or BLOCKS
    sources = water_fill(rank_sources(rows), weights)
    size, target = F.col("source_size"), F.col("target")
    times = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("int")
    sources = materialize(sources.withColumn("times", times).withColumn("left", target - F.col("times") * size), "targets")
    if shards is None:
        words = sources.agg(F.sum("target")).first()[0] or 0.0
        shards = max(1, int(-(-words // SHARD_WORDS)))

    # The blocks of a source in permuted order: whole ones up to what is left, then one in part.
    held = rows.groupBy(F.col("_source"), _block(blocks)).agg(F.sum("_size").alias("words"))
    held = held.join(sources, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    order = Window.partitionBy("idx").orderBy(F.xxhash64(F.lit(seed), "idx", "_block"), "_block")
    upto = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = held.withColumn("upto", upto).withColumn("whole", (F.col("upto") <= F.col("left")) & (size > 0))
    before = F.col("upto") - F.col("words")
    held = held.withColumn("room", F.when((F.col("upto") > F.col("left")) & (before <= F.col("left")), F.col("left") - before))
    held = materialize(held, "blocks")
    # The block that is drawn in part: its documents in key order, up to the words that are left.
    cut = held.where("room is not null").select("source", F.col("_block").alias("b"), "idx", "room")
    near = rows.select("_source", "_size", "_key", _block(blocks)).join(cut, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_block") == F.col("b")))
    near = near.withColumn("_upto", F.sum("_size").over(Window.partitionBy("idx").orderBy("_key")))
    last = near.where(F.col("_upto") - F.col("_size") / 2 <= F.col("room")).groupBy("idx", "_block").agg(F.max("_key").alias("upto_key"))
    held = held.join(last, ["idx", "_block"], "left")
    held = materialize(held.withColumn("n_draws", F.col("times") + (F.col("whole") | F.col("upto_key").isNotNull()).cast("int")), "block-draws")

    turns = held.where("n_draws > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("n_draws") - 1)))
    partial = F.when(F.col("turn") == F.col("times"), F.col("upto_key"))
    turns = turns.select("idx", "_block", "turn", partial.alias("upto"), F.pmod(F.xxhash64(F.lit(seed), "idx"), F.lit(GROUPS)).alias("grp"))
    in_group = Window.partitionBy("grp").orderBy(F.xxhash64(F.lit(seed + 2), "idx", "_block", "turn"), "idx", "_block", "turn")
    turns = materialize(turns.withColumn("place", (F.row_number().over(in_group) - 1).cast("long")), "turns")
    quotas = np.zeros(GROUPS, np.int64)
    for r in turns.groupBy("grp").count().collect():
        quotas[r.grp] = r["count"]
    ranges = shard_ranges(spark, quotas, shards, seed)
    places = ranges.select("grp", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("place"))
    to = turns.join(places, ["grp", "place"]).groupBy("idx", "_block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard", "upto"))).alias("draws"))
    out = materialize(held.join(to, ["idx", "_block"], "left").select("source", "_block", "source_size", "target", "draws"), "mix-plan")
    release(held, turns)
    return MixPlan(out, blocks, shards, seed)


def draws(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """(_row, _size, source_size, target, _key, _draws): rows of :func:`keyed` with the draws that take them."""
    of_block = plan.blocks.withColumnRenamed("_block", "_b")
    of_block = F.broadcast(of_block) if of_block.count() <= BROADCAST_ROWS else of_block
    met = rows.withColumn("_block", _block(plan.n_blocks)).join(of_block, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_block") == F.col("_b")))
    taken = F.filter("draws", lambda d: d["upto"].isNull() | (F.col("_key") <= d["upto"]))
    return met.select("_row", "_size", "source_size", "target", "_key", F.when(F.col("_size") > 0, taken).alias("_draws"))


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED, weights: Callable[[Column], Column] = cycle_weights) -> DataFrame:
    """The columns of ``docs``, a row for each draw, shards in order in the partitions and shuffled within each."""
    rows = keyed(docs, seed)
    slim = materialize(rows.drop("_row"), "sizes")
    plan = plan_mix(slim, shards, seed, weights)
    release(slim)
    drawn = draws(rows, plan).select("_row", "_key", F.explode("_draws").alias("_d"))
    drawn = drawn.withColumn("_order", F.xxhash64(F.lit(seed + 1), "_key", "_d.turn"))
    each = -(-plan.shards // PARTITIONS)
    dealt = drawn.repartitionById(-(-plan.shards // each), F.floor(F.col("_d.shard") / each).cast("int"))
    return dealt.sortWithinPartitions("_d.shard", "_order").select("_row.*")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    rows = keyed(docs, SEED).withColumn("_row", F.struct("_row.doc_id"))
    rows = materialize(rows, "sizes")
    out = draws(rows, plan_mix(rows, seed=SEED))
    return out.select("_row.doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.coalesce(F.size("_draws"), F.lit(0))).cast("long").alias("taken"))
