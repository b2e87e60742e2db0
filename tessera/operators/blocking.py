"""Candidate generation: shared distinctive tokens inside a country, then n-gram cosine.

A token is distinctive if at most ``max(1, int(max_df_ratio * n))`` of the n
records of sources 2 and 3 of its country hold it. That cut bounds the
postings of every token, and the cap on postings bounds them again, so the
join on (country, token) has no hot key; the caps are features of the
operator and take the first by a stated order. :data:`WHOLE` has neither the
cap on postings nor that on candidates: the best are those of all pairs that
share a distinctive token.

Pairs before the cap may be thousands a record, so :func:`candidates` never
makes a table of them: a tile of source-1 records meets the pool of its
country in one task (:mod:`tessera.operators.tiles`). :func:`plain_candidates`
is the same by joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.similarity import gram_cosine
from tessera.functions.tokens import blocking_tokens
from tessera.operators import tiles
from tessera.operators.entities import has_unique_ids

#: Source-1 records of a tile: a country has up to TILES tiles, and more only if they would be larger than the most.
TILES, LEAST_TILE, MOST_TILE = 16, 2048, 32768


@dataclass(frozen=True)
class Blocking:
    k: int = 20
    sim_floor: float = 0.3
    max_candidates: int | None = 300
    max_df_ratio: float = 0.05
    max_postings: int | None = 5000
    min_token_len: int = 2


#: No cap before the score: every pair that shares a distinctive token is scored.
WHOLE = Blocking(max_candidates=None, max_postings=None)


def token_rows(entities: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """(country_clean, token, entity_id, source, ord): distinct tokens of each record."""
    words = blocking_tokens(F.col("business_name_clean"), p.min_token_len)
    return entities.select("country_clean", F.explode(words).alias("token"), "entity_id", "source", "ord")


def document_frequency(pool: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """(country_clean, token, df, max_df) over sources 2 and 3."""
    per_country = pool.groupBy("country_clean").agg(F.greatest(F.lit(1), F.floor(F.lit(p.max_df_ratio) * F.count("*"))).cast("long").alias("max_df"))
    df = token_rows(pool, p).groupBy("country_clean", "token").agg(F.count("*").alias("df"))
    return df.join(per_country, "country_clean")


def common_tokens(pool: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    return document_frequency(pool, p).where(F.col("df") > F.col("max_df")).select("country_clean", "token", "df")


def _posted(pool: DataFrame, p: Blocking) -> DataFrame:
    """(country_clean, token, entity_id, at, df): of distinctive tokens, the first by source and ord, or all; at is the token's place in its record."""
    kept = document_frequency(pool, p).where(F.col("df") <= F.col("max_df")).select("country_clean", "token", "df")
    first = F.row_number().over(Window.partitionBy("country_clean", "token").orderBy("source", "ord", "entity_id"))
    words = blocking_tokens(F.col("business_name_clean"), p.min_token_len)
    rows = pool.select("country_clean", "entity_id", "source", "ord", F.posexplode(words).alias("at", "token")).join(kept, ["country_clean", "token"])
    if p.max_postings is not None:
        rows = rows.withColumn("_n", first).where(F.col("_n") <= p.max_postings)
    return rows.select("country_clean", "token", "entity_id", "at", "df")


def postings(pool: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """(country_clean, token, candidate_entity_id, df): of distinctive tokens, the first by source and ord."""
    return _posted(pool, p).select("country_clean", "token", F.col("entity_id").alias("candidate_entity_id"), "df")


def blocking_pairs(s1: DataFrame, pool: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, n_shared, min_df) before caps and floor."""
    mine = token_rows(s1, p).select("country_clean", "token", F.col("entity_id").alias("source1_entity_id"))
    met = mine.join(postings(pool, p), ["country_clean", "token"])
    return met.groupBy("source1_entity_id", "candidate_entity_id").agg(F.count("*").alias("n_shared"), F.min("df").alias("min_df"))


def cap_candidates(pairs: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """The most promising of each record: most shared tokens, then the rarest, then by id; all without a cap."""
    if p.max_candidates is None:
        return pairs
    rank = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(F.desc("n_shared"), "min_df", "candidate_entity_id"))
    return pairs.withColumn("_n", rank).where(F.col("_n") <= p.max_candidates).drop("_n")


def score(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Pairs with blocking_score, the cosine of the names' n-gram counts."""
    a = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("business_name_clean").alias("_a"))
    b = pool.select(F.col("entity_id").alias("candidate_entity_id"), F.col("business_name_clean").alias("_b"))
    met = pairs.join(a, "source1_entity_id").join(b, "candidate_entity_id")
    return met.withColumn("blocking_score", F.round(gram_cosine("_a", "_b"), 6)).drop("_a", "_b")


def top_k(scored: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(F.desc("blocking_score"), "candidate_entity_id"))
    kept = scored.where(F.col("blocking_score") >= p.sim_floor).withColumn("_n", rank).where(F.col("_n") <= p.k)
    return kept.select("source1_entity_id", "candidate_entity_id", "blocking_score")


def plain_candidates(entities: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """The whole composite by joins, with a row for each pair before the cap."""
    s1, pool = entities.where("source = 1"), entities.where("source <> 1")
    return top_k(score(cap_candidates(blocking_pairs(s1, pool, p), p), s1, pool), p)


def _tiled(entities: DataFrame, p: Blocking) -> DataFrame:
    """Rows for :func:`tiles.best`: source-1 records dealt to the tiles of their country, and the pool in each of them."""
    s1 = entities.where("source = 1 and country_clean is not null and business_name_clean is not null")
    pool, n = entities.where("source <> 1"), F.count("*")
    size = F.least(F.greatest(n / TILES, F.lit(LEAST_TILE)), F.lit(MOST_TILE))
    dealt = s1.groupBy("country_clean").agg(F.ceil(n / size).cast("int").alias("_tiles"))
    tile, name = F.concat_ws(":", "_tile", "country_clean").alias("tile"), F.col("business_name_clean").alias("name")
    mine = s1.join(dealt, "country_clean").withColumn("_tile", F.pmod(F.xxhash64("entity_id"), F.col("_tiles")))
    mine = mine.select(tile, F.lit(0).alias("kind"), "entity_id", name, F.lit(None).cast("array<int>").alias("at"), F.lit(None).cast("array<int>").alias("dfs"))
    lists = _posted(pool, p).groupBy("entity_id").agg(F.collect_list(F.struct("at", F.col("df").cast("int").alias("df"))).alias("_l"))
    theirs = pool.select("entity_id", "country_clean", "business_name_clean").join(lists, "entity_id").join(dealt, "country_clean")
    theirs = theirs.withColumn("_tile", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    theirs = theirs.select(tile, F.lit(1).alias("kind"), "entity_id", name, F.col("_l.at").alias("at"), F.col("_l.df").alias("dfs"))
    total = dealt.agg(F.sum("_tiles")).first()[0] or 1
    return mine.unionByName(theirs).repartition(min(2 * total, 4096), "tile").sortWithinPartitions("tile", "kind", "entity_id")


def _of_tiles(entities: DataFrame, p: Blocking, k: int | None) -> DataFrame:
    min_len, most, floor = p.min_token_len, p.max_candidates, p.sim_floor
    return _tiled(entities, p).mapInArrow(lambda batches: tiles.best(batches, min_len, most, k, floor), "source1_entity_id string, candidate_entity_id string, blocking_score double")


def capped_scores(entities: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, blocking_score) of all pairs under the cap."""
    if p.max_candidates is None or not has_unique_ids(entities):
        s1, pool = entities.where("source = 1"), entities.where("source <> 1")
        return score(cap_candidates(blocking_pairs(s1, pool, p), p), s1, pool).select("source1_entity_id", "candidate_entity_id", "blocking_score")
    return _of_tiles(entities, p, None)


def candidates(entities: DataFrame, p: Blocking = Blocking()) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, blocking_score): the whole composite.

    An id that stands for several records has the pairs of all of them; such
    sources are joined row by row. So is one cap without the other, as records
    of one name then differ in their postings.
    """
    tiled = (p.max_candidates is None) <= (p.max_postings is None) and has_unique_ids(entities)
    return _of_tiles(entities, p, p.k) if tiled else plain_candidates(entities, p)


def to_wide(pairs: DataFrame, ids: DataFrame, id_col: str = "candidate_entity_id", order_col: str = "blocking_score", out: str = "candidate_entity_ids") -> DataFrame:
    """Every source-1 id with its ids, best first, as a comma list; blank without any.

    ``pairs`` holds at most a few ids a record, as after :func:`top_k`.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col(order_col)).alias("o"), F.col(id_col).alias("i"))))
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.transform(ordered, lambda x: x["i"]), ",").alias(out))
    return ids.select("source1_entity_id").distinct().join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(out, F.lit("")).alias(out))


def recall(pairs: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """One row: true pairs, those among the candidates, and the share."""
    truth = truth_pairs.select("source1_entity_id", "candidate_entity_id").distinct()
    found = truth.join(pairs.select("source1_entity_id", "candidate_entity_id", F.lit(1).alias("hit")), ["source1_entity_id", "candidate_entity_id"], "left")
    return found.agg(F.count("*").alias("n_true"), F.count("hit").alias("n_found")).select("n_true", "n_found", F.round(F.coalesce(F.try_divide("n_found", "n_true"), F.lit(0.0)), 6).alias("recall"))
