"""Pair features: TF-IDF vectors, and the feature row of each candidate pair."""

from __future__ import annotations

from functools import reduce

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import similarity, tokens
from tessera.operators import meetings
from tessera.operators.entities import explode_truth, has_unique_ids, needed_entities
from tessera.workspace import materialize, tidy

# The features and their order.
FEATURES = [
    "name_token_jaccard", "name_seq_ratio", "name_tfidf_cosine", "address_token_jaccard",
    "address_seq_ratio", "country_match", "name_length_diff", "name_first_token_match",
]
#: The idf table has at most this many rows, 20 MB or so, and is broadcast.
MAX_FEATURES = 500_000
#: Source-1 texts that one task holds while the other side's go by; fewer where it holds them whole.
HELD, HELD_WHOLE = 40_000, 10_000
#: Records of one name that are dealt to a tile of ratios together, as they meet mostly the same; more go in several parts.
TOGETHER = 100
#: Texts that a round of tiles moves at most: as many as there are, and more only if they are few (or one tile has more).
LEAST_ROUND = 50_000


def lookup(entities: DataFrame) -> DataFrame:
    """What the features need of each entity, computed once an entity."""
    name = tokens.tokens(F.col("business_name_clean"))
    return entities.select(
        "entity_id", "business_name_clean", "business_address_clean", "country_clean",
        name.alias("name_tokens"), tokens.tokens(F.col("business_address_clean")).alias("address_tokens"),
        F.char_length("business_name_clean").alias("name_len"), tokens.first_token(name).alias("first_tok"),
    )


def gram_counts(entities: DataFrame) -> DataFrame:
    """(entity_id, gram, tf) of the names."""
    grams = tokens.char_wb(F.col("business_name_clean"))
    return entities.select("entity_id", F.explode(grams).alias("gram")).groupBy("entity_id", "gram").agg(F.count("*").alias("tf"))


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows by a unique order, however many they are: ranged and numbered, never in one task.

    What goes over all partitions is a row for each.
    """
    parts = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    near = parts.join(F.broadcast(before.where(F.col("_before") < n)), "_part").withColumn("_place", place)
    return near.where(F.col("_before") + F.col("_place") <= n).select(*df.columns)


def fit_idf(entities: DataFrame, min_df: int = 2, max_features: int = MAX_FEATURES, sample: int | None = None, seed: int = 42) -> DataFrame:
    """(gram, idf) of grams in at least ``min_df`` names, the most frequent ``max_features`` of them.

    All names by default; ``sample`` bounds them, taken by a hash of the id.
    """
    if sample is not None:
        entities = first_rows(entities.withColumn("_o", F.xxhash64("entity_id", F.lit(seed))), sample, F.col("_o"), F.col("entity_id")).drop("_o")
    counts = gram_counts(entities).groupBy("gram").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)
    top = first_rows(counts, max_features, F.col("total").desc(), F.col("gram"))
    n = entities.agg(F.count("*")).scalar()
    return top.select("gram", "df", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def tfidf_vectors(entities: DataFrame, idf: DataFrame) -> DataFrame:
    """(entity_id, grams, weights): unit vectors as parallel arrays; none for names without known grams."""
    weights = gram_counts(entities).join(F.broadcast(idf.select("gram", "idf")), "gram").select("entity_id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    rows = weights.groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct("gram", "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.select("entity_id", F.col("v.gram").alias("grams"), F.transform("v.w", lambda w: w / F.col("norm")).alias("weights"))


def _sides(pairs: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Pairs with the columns of ``table`` for both ids, prefixed s1_ and cand_."""
    for side, key in (("s1", "source1_entity_id"), ("cand", "candidate_entity_id")):
        renamed = table.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in table.columns if c != "entity_id"])
        pairs = pairs.join(renamed, key, how)
    return pairs


def tfidf_cosine(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs with name_tfidf_cosine; 0 where an entity has no vector."""
    met = _sides(pairs, vectors, "left")
    return met.select(*pairs.columns, similarity.sparse_dot("s1_grams", "s1_weights", "cand_grams", "cand_weights").alias("name_tfidf_cosine"))


def name_cosines(pairs: DataFrame, entities: DataFrame, idf: DataFrame) -> DataFrame:
    """The same from the names: pairs carry two names and not two vectors."""
    met = _sides(pairs, entities.select("entity_id", "business_name_clean"), "left")
    return _cosines(met.select(*pairs.columns, F.col("s1_business_name_clean").alias("_a"), F.col("cand_business_name_clean").alias("_b")), _held(idf))


def _held(idf: DataFrame) -> Broadcast:
    """The idf table for every task."""
    table = idf.select("gram", "idf").toArrow()
    return idf.sparkSession.sparkContext.broadcast((table["gram"].to_pylist(), table["idf"].to_numpy()))


def _cosines(met: DataFrame, held: Broadcast) -> DataFrame:
    """Rows with name_tfidf_cosine in place of the names _a and _b."""
    schema = ", ".join(f"`{c}` {t}" for c, t in met.dtypes if c not in ("_a", "_b"))
    return met.mapInArrow(lambda batches: meetings.cosines(batches, *held.value), f"{schema}, name_tfidf_cosine double")


def address_features(pairs: DataFrame, entities: DataFrame, ratios: bool = False) -> DataFrame:
    """Distinct pairs with address_token_jaccard, and with address_seq_ratio if asked for. Ids are unique in ``entities``.

    Source-1 records are dealt to tiles inside their country; a tile holds
    their texts and sees each text that they meet once. Ratios need whole texts
    in small tiles, which copies the other side's more often: their tiles go
    in rounds, each written before the next one moves its texts.
    """
    pairs = pairs.select("source1_entity_id", "candidate_entity_id").distinct()
    key = F.coalesce("country_clean", F.lit("")).alias("_country")
    held = HELD_WHOLE if ratios else HELD
    n = entities.join(pairs.select(F.col("source1_entity_id").alias("entity_id")).distinct(), "entity_id", "left_semi").groupBy(key).agg(F.ceil(F.count("*") / F.lit(held)).cast("int").alias("_tiles"))
    n = materialize(n, "tiles")
    who = entities.select("entity_id", key, "business_name_clean").withColumn("_dealt", F.xxhash64("entity_id"))
    if ratios:
        parts = who.groupBy("business_name_clean").agg(F.ceil(F.count("*") / F.lit(TOGETHER)).alias("_parts"))
        who = who.join(parts, "business_name_clean", "left").withColumn("_dealt", F.xxhash64("business_name_clean", F.pmod("_dealt", F.coalesce("_parts", F.lit(1)))))
    number = F.pmod("_dealt", F.col("_tiles"))
    dealt = who.join(n, "_country").select("entity_id", "_country", F.concat_ws(":", number, "_country").alias("tile"))
    met = pairs.join(dealt.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id")
    if not ratios:
        return _met_texts(met, entities, n.agg(F.sum("_tiles")).first()[0] or 1, False)
    there = entities.select(F.col("entity_id").alias("candidate_entity_id"), F.coalesce("country_clean", F.lit("")).alias("_there"))
    met = materialize(met.join(there, "candidate_entity_id"), "dealt")
    done = [_round(met, entities, *some) for some in rounds(met, entities.count())]
    return reduce(DataFrame.unionByName, done) if done else _met_texts(met, entities, 1, True)


def rounds(met: DataFrame, n: int) -> list[tuple[list[str], list[str]]]:
    """Tiles of each round and the countries of their texts, of pairs dealt to tiles.

    A round moves at most ``n`` texts, or LEAST_ROUND if that is more, unless
    one tile alone has more. There is a row for each tile, which is thousands of records.
    """
    left = met.select("_country", "tile", F.col("source1_entity_id").alias("entity_id"), F.col("_country").alias("_there"))
    right = met.select("_country", "tile", F.col("candidate_entity_id").alias("entity_id"), "_there")
    sizes = left.union(right).distinct().groupBy("_country", "tile").agg(F.count("*").alias("texts"), F.collect_set("_there").alias("there"))
    out, room = [], 0
    for r in sizes.orderBy("_country", "tile").collect():
        if not out or r.texts > room:
            out.append(([], set()))
            room = max(n, LEAST_ROUND)
        room -= r.texts
        out[-1][0].append(r.tile)
        out[-1][1].update(r.there, [r._country])
    return [(tiles, sorted(there)) for tiles, there in out]


def _round(met: DataFrame, entities: DataFrame, tiles: list[str], countries: list[str]) -> DataFrame:
    """The rows of some tiles as a written table; the shuffle files go with it."""
    texts = entities.where(F.coalesce("country_clean", F.lit("")).isin(countries))
    out = materialize(_met_texts(met.where(F.col("tile").isin(tiles)), texts, 2 * len(tiles), True), "addresses")
    tidy(met.sparkSession)
    return out


def _met_texts(met: DataFrame, entities: DataFrame, total: int, ratios: bool) -> DataFrame:
    """The features of pairs dealt to tiles, about ``total`` of them."""
    texts = entities.select("entity_id", F.col("business_address_clean").alias("text"))
    mine = met.select("tile", F.col("source1_entity_id").alias("entity_id")).distinct().withColumns({"kind": F.lit(0), "ids": F.lit(None).cast("array<string>")})
    theirs = met.groupBy("tile", F.col("candidate_entity_id").alias("entity_id")).agg(F.sort_array(F.collect_list("source1_entity_id")).alias("ids")).withColumn("kind", F.lit(1))
    rows = mine.unionByName(theirs).join(texts, "entity_id").select("tile", "kind", "entity_id", "text", "ids")
    order = ("tile", "kind", "ids", "text") if ratios else ("tile", "kind")  # what meets the same texts, and equal texts, in turn
    rows = rows.repartition(min(2 * total, 4096), "tile").sortWithinPartitions(*order)
    schema = "source1_entity_id string, candidate_entity_id string, address_token_jaccard double"
    return rows.mapInArrow(lambda batches: meetings.addresses(batches, ratios), schema + ", address_seq_ratio double" * ratios)


def token_jaccards(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    met = _sides(pairs, lookup(entities))
    return met.select(
        *pairs.columns,
        similarity.jaccard(F.col("s1_name_tokens"), F.col("cand_name_tokens")).alias("name_token_jaccard"),
        similarity.jaccard(F.col("s1_address_tokens"), F.col("cand_address_tokens")).alias("address_token_jaccard"),
    )


def flags(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    return _flag_columns(_sides(pairs, lookup(entities)), pairs.columns)


def _flag_expressions() -> list:
    return [
        (F.col("s1_country_clean") == F.col("cand_country_clean")).cast("int").alias("country_match"),
        F.coalesce(F.abs(F.col("s1_name_len") - F.col("cand_name_len")), F.lit(0)).alias("name_length_diff"),
        ((F.col("s1_first_tok") == F.col("cand_first_tok")) & (F.col("s1_first_tok") != "")).cast("int").alias("name_first_token_match"),
    ]


def _flag_columns(met: DataFrame, kept: list[str]) -> DataFrame:
    return met.select(*kept, *_flag_expressions())


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with label 1 where the ground truth has them, else 0."""
    true = explode_truth(truth).distinct().withColumn("label", F.lit(1))
    met = pairs.join(true, ["source1_entity_id", "candidate_entity_id"], "left")
    return met.select(*pairs.columns, F.coalesce("label", F.lit(0)).alias("label"))


def feature_rows(pairs: DataFrame, entities: DataFrame, truth: DataFrame | None = None, idf: DataFrame | None = None) -> DataFrame:
    """Two ids, the eight features in order, and the label if there is a ground truth.

    A pair with an id that ``entities`` lacks has no features and is dropped;
    count both sides to see how many.
    """
    pairs = pairs.select("source1_entity_id", "candidate_entity_id")
    if not has_unique_ids(entities):
        return _joined_rows(pairs, entities, truth, idf)
    # Each phase moves much: its shuffle files go before the next one begins.
    held = _held(fit_idf(needed_entities(pairs, entities)) if idf is None else idf)
    tidy(pairs.sparkSession)
    addresses = address_features(pairs, entities, True)
    met = _sides(pairs, entities.select("entity_id", "business_name_clean", "country_clean"))
    for side in ("s1", "cand"):
        met = met.withColumn(f"{side}_name_tokens", tokens.tokens(F.col(f"{side}_business_name_clean")))
        met = met.withColumns({f"{side}_name_len": F.char_length(f"{side}_business_name_clean"), f"{side}_first_tok": tokens.first_token(F.col(f"{side}_name_tokens"))})
    met = met.select(
        "source1_entity_id", "candidate_entity_id",
        similarity.jaccard(F.col("s1_name_tokens"), F.col("cand_name_tokens")).alias("name_token_jaccard"),
        similarity.seq_ratio("s1_business_name_clean", "cand_business_name_clean").alias("name_seq_ratio"),
        *_flag_expressions(), F.col("s1_business_name_clean").alias("_a"), F.col("cand_business_name_clean").alias("_b"),
    )
    rows = _cosines(met, held).join(addresses, ["source1_entity_id", "candidate_entity_id"])
    rows = rows.select("source1_entity_id", "candidate_entity_id", *FEATURES)
    return rows if truth is None else label(rows, truth)


def _joined_rows(pairs: DataFrame, entities: DataFrame, truth: DataFrame | None, idf: DataFrame | None) -> DataFrame:
    """Feature rows by joins that copy both sides' texts and vectors into every pair, for ids that repeat."""
    needed = needed_entities(pairs, entities)
    vectors = tfidf_vectors(needed, fit_idf(needed) if idf is None else idf)
    table = lookup(needed).join(vectors, "entity_id", "left")
    met = _sides(pairs, table)
    rows = met.select(
        "source1_entity_id", "candidate_entity_id",
        similarity.jaccard(F.col("s1_name_tokens"), F.col("cand_name_tokens")).alias("name_token_jaccard"),
        similarity.seq_ratio("s1_business_name_clean", "cand_business_name_clean").alias("name_seq_ratio"),
        similarity.sparse_dot("s1_grams", "s1_weights", "cand_grams", "cand_weights").alias("name_tfidf_cosine"),
        similarity.jaccard(F.col("s1_address_tokens"), F.col("cand_address_tokens")).alias("address_token_jaccard"),
        similarity.seq_ratio("s1_business_address_clean", "cand_business_address_clean").alias("address_seq_ratio"),
        *_flag_expressions(),
    )
    rows = rows.select("source1_entity_id", "candidate_entity_id", *FEATURES)
    return rows if truth is None else label(rows, truth)
