"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut at line feeds and sentence ends, and every 64 characters, and
each distinct piece has a 44-bit digest with a 20-bit check. A sketch has
three tables of cells; a digest lies in one cell of each, and a cell holds the
count and the exclusive-or of its digests. Two versions' sketches of one size
subtract cell by cell, which leaves the digests that only one version has. A
cell whose count is 1 or -1 and whose check holds is a single digest: it is
taken out of its other two cells, which may leave single digests there.
Peeling goes on until nothing is left; the digests taken out are what differs,
and :func:`differences` gives them. Where something is left, the sketches were
too small, or hashed unluckily: both are made again, larger and with another
hash. After ``MAX_LEVEL`` such sizes the digests themselves are compared.

The fingerprint is the sketch of the text at its least size, ``BASE`` cells a
table, written out; :func:`likeness` subtracts and peels two of these, and
gives None where they differ too much for their size. A comparison starts from
sketches that hold all digests of both texts if need be: an edit of half a
text differs in about as many as the text has.

Only DataFrame functions are used. Pieces are exploded next to the text and
cells aggregated there: once a text and its neighbour have met, all rounds of
peeling run in the partition of the document, without a shuffle.

Defined results: a null text is empty. Two texts without pieces have likeness
1, one with pieces and one without 0. A row without doc_id stands below every
id. Rows that share a doc_id are one document for their neighbour, which sees
the least of their texts; each row is compared for itself. An empty table gives
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.native import documents, text_or_empty
from tessera.workspace import materialize, release

PIECE = r"[^\n.!?]{1,64}[.!?]*|[.!?]+"
#: Cells of one table of the fingerprint itself, and the least for a comparison.
BASE = 8
LEAST = 64
ROUNDS = 9
MAX_LEVEL = 8
#: Ids up to this many are broadcast when failed comparisons are made again.
BROADCAST_ROWS = 200_000
_LOWEST = -(1 << 63)
_CHECK = (1 << 20) - 1


def digests(text: Column) -> Column:
    """The distinct digests of a text's pieces: 44 bits of hash, 20 bits of check."""

    def digest(piece: Column) -> Column:
        high = F.xxhash64(piece).bitwiseAND(F.lit(~_CHECK))
        return high.bitwiseOR(F.xxhash64(high).bitwiseAND(F.lit(_CHECK)))

    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), digest))


def _checked(digest: Column) -> Column:
    return digest.bitwiseAND(F.lit(_CHECK)) == F.xxhash64(digest.bitwiseAND(F.lit(~_CHECK))).bitwiseAND(F.lit(_CHECK))


def _place(digest: Column, table: int, size: Column, level: int) -> Column:
    """The cell of a digest in a table of ``size`` cells, a power of two; cells count through the tables."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(level), digest), 21 * table)
    return h.bitwiseAND(size - 1) * 3 + table


def edited(text: Column, following: Column) -> Column:
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def _long(hex16: Column) -> Column:
    return F.conv(hex16, 16, -10).cast("long")


def _facts(row: list[Column]) -> list[Column]:
    """Numbers of a row as cells of what 4, which pass through all rounds."""
    return [F.struct(F.lit(4).alias("what"), F.lit(i).cast("long").alias("cell"), F.lit(1).cast("long").alias("n"), c.cast("long").alias("x")) for i, c in enumerate(row)]


def _cells(rows: DataFrame, level: int) -> DataFrame:
    """(k, th, size, what, cell, n, x): nonempty cells.

    what 0 and 1: the fingerprints of the text and its edit, in BASE cells a
    table, whatever the level. what 2 and 3: the text's sketch less the edit's,
    and less the next document's. what 4: facts of the row.
    """
    need = F.size("own") + F.greatest(F.size("edit"), F.size("next"))
    power = F.ceil(F.log2((need + 1) * (2.0**level) / 1.5)).cast("int")
    size = F.greatest(F.lit(LEAST << level), F.pow(F.lit(2.0), power).cast("long"))
    sized = rows.withColumn("size", size.cast("long"))
    # 1: in the text, 2: in its edit, 4: in the next document, 0: a fact

    def marked(digests: str, w: int) -> Column:
        return F.transform(digests, lambda d: F.struct(d.alias("d"), F.lit(w).alias("w")))

    whole = [marked("own", 1), marked("edit", 2), marked("next", 4)]
    facts = ["rows", "n_chars", *[_long(F.substring("edited_sha256", 1 + 16 * i, 16)) for i in range(4)], F.size("own"), F.size("edit"), F.size("next")]
    facts = [F.col(c) if isinstance(c, str) else c for c in facts]
    fact_rows = F.array(*[F.struct(c.cast("long").alias("d"), F.lit(-1 - i).alias("w")) for i, c in enumerate(facts)])
    each = sized.select("k", "th", "size", F.inline(F.concat(*whole, fact_rows)))
    base = F.lit(BASE).cast("long")
    d, w = F.col("d"), F.col("w")
    own, edit, following, fact = w == 1, w == 2, w == 4, w < 0

    def cell(what: Column, at: Column, n: Column) -> Column:
        return F.struct(what.cast("int").alias("what"), at.cast("long").alias("cell"), n.cast("long").alias("n"), d.alias("x"))

    sign = F.when(own, 1).otherwise(-1)
    small = [cell(F.when(own, 0).otherwise(1), _place(d, t, base, 0), F.lit(1)) for t in range(3)]
    less_edit = [cell(F.lit(2), _place(d, t, F.col("size"), level), sign) for t in range(3)]
    less_next = [cell(F.lit(3), _place(d, t, F.col("size"), level), sign) for t in range(3)]
    parts = F.when(own, F.array(*small, *less_edit, *less_next)).when(edit, F.array(*small, *less_edit)).when(following, F.array(*less_next))
    parts = parts.otherwise(F.array(cell(F.lit(4), -1 - w, F.lit(1))))
    return _sum(each.select("k", "th", "size", F.inline(parts)))


def _sum(cells: DataFrame) -> DataFrame:
    out = cells.groupBy("k", "th", "size", "what", "cell").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"))
    return out.where("n <> 0 or x <> 0")


def _peel(cells: DataFrame, level: int, rounds: int = ROUNDS) -> DataFrame:
    """Take single digests out, one table at a time, so that each is found once a round.

    What is taken out are rows of its own: what 5 for a digest of the text that
    its edit lacks, 6 for one that only the edit has, 7 and 8 likewise for the
    next document; the cell is the digest.
    """
    for r in range(rounds):
        t = r % 3
        x, n, size, what = F.col("x"), F.col("n"), F.col("size"), F.col("what")
        single = what.isin(2, 3) & (F.col("cell") % 3 == t) & (F.abs(n) == 1)
        single = F.when(single, _checked(x) & (_place(x, t, size, level) == F.col("cell"))).otherwise(False)

        def row(what: Column, cell: Column, n: Column, x: Column) -> Column:
            return F.struct(what.cast("int").alias("what"), cell.cast("long").alias("cell"), n.cast("long").alias("n"), x.cast("long").alias("x"))

        others = [row(what, _place(x, o, size, level), -n, x) for o in range(3) if o != t]
        found = row(2 * what + F.when(n > 0, 1).otherwise(2), x, F.lit(1), F.lit(0))
        moved = F.when(single, F.array(*others, found)).otherwise(F.array(row(what, F.col("cell"), n, x)))
        cells = _sum(cells.select("k", "th", "size", F.inline(moved)))
    return cells


def _compare(rows: DataFrame, level: int) -> DataFrame:
    """A row for each document with fingerprints, likenesses, and whether any digest is left."""
    peeled = _peel(_cells(rows, level), level)
    what, cell, n, x = F.col("what"), F.col("cell"), F.col("n"), F.col("x")

    def fp(i: int) -> Column:
        """The cells in order: two hexadecimal digits for the place, eight for the count, 16 for the digests."""
        cells = F.sort_array(F.collect_list(F.when(what == i, F.struct(cell, n, x))))
        digits = [("cell", 2), ("n", 8), ("x", 16)]
        return F.lower(F.array_join(F.transform(cells, lambda c: F.concat(*[F.lpad(F.hex(c[f]), w, "0") for f, w in digits])), ""))

    def fact(i: int) -> Column:
        return F.max(F.when((what == 4) & (cell == i), x))

    def differ(i: int) -> Column:
        return F.count(F.when(what.isin(2 * i + 1, 2 * i + 2), 1))

    aggs = [fp(0).alias("fingerprint"), fp(1).alias("edited_fingerprint"), differ(2).alias("d_edit"), differ(3).alias("d_next")]
    aggs += [fact(i).alias(f) for i, f in enumerate(["rows", "n_chars", "s0", "s1", "s2", "s3", "n_own", "n_edit", "n_next"])]
    left = F.max(what.isin(2, 3))
    out = peeled.groupBy("k", "th").agg(*aggs, left.alias("left"))
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 16, "0") for i in range(4)]))
    return out.select(
        "k", "th", "rows", "left", "n_chars", sha.alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        _alike(F.col("n_own"), F.col("n_edit"), F.col("d_edit")).alias("near_edited"), _alike(F.col("n_own"), F.col("n_next"), F.col("d_next")).alias("near_next"),
    )


def _alike(a: Column, b: Column, differ: Column) -> Column:
    """The share of common digests among all, from the numbers of both and of those that differ."""
    common = (a + b - differ) / 2
    whole = a + b - common
    return F.when(whole == 0, 1.0).otherwise(common / whole)


def _exactly(rows: DataFrame) -> DataFrame:
    """(k, th, near_edited, near_next) from the digests themselves."""

    def alike(other: str) -> Column:
        differ = F.size(F.array_except("own", other)) + F.size(F.array_except(other, "own"))
        return _alike(F.size("own"), F.size(other), differ)

    return rows.select("k", "th", alike("edit").alias("near_edited"), alike("next").alias("near_next"))


def differences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = 0) -> DataFrame:
    """(doc_id, against, side, digest): what peeling recovers of each text against its ``edit`` and against the ``next`` document.

    ``side`` is ``own`` for a digest that only the text has, else ``other``.
    Documents with a comparison that does not peel at this level have no rows.
    """
    docs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LOWEST)).alias("k"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    pairs, repeats = neighbours(docs)
    peeled = materialize(_peel(_cells(_rows(docs, pairs, repeats), level), level), "peeled")
    bad = materialize(peeled.where("what in (2, 3)").select("k", "th").distinct(), "not-peeled")
    found = peeled.where("what > 4").join(bad, ["k", "th"], "left_anti")
    what = F.col("what")
    return found.select(
        F.when(F.col("k") != _LOWEST, F.col("k")).alias("doc_id"), F.when(what < 7, "edit").otherwise("next").alias("against"),
        F.when(what % 2 == 1, "own").otherwise("other").alias("side"), F.col("cell").alias("digest"),
    )


def _read(fingerprint: str) -> dict[int, tuple[int, int]]:
    cells = [fingerprint[i : i + 26] for i in range(0, len(fingerprint), 26)]
    return {int(c[:2], 16): (int(c[2:10], 16), int(c[10:], 16)) for c in cells}


def _places(digest: int) -> list[int]:
    """The cells of a digest in a fingerprint, as :func:`_place` gives them; none if its check fails."""
    from xxhash import xxh64_intdigest

    def long(x: int) -> bytes:
        return x.to_bytes(8, "little")

    high = digest & ~_CHECK
    if xxh64_intdigest(long(high), 42) & _CHECK != digest & _CHECK:
        return []
    h = xxh64_intdigest(long(digest), xxh64_intdigest(bytes(4), 42))
    return [(h >> 21 * t & BASE - 1) * 3 + t for t in range(3)]


def likeness(a: str, b: str) -> float | None:
    """Of two fingerprints; None if they differ in more digests than they can tell."""
    x, y = _read(a), _read(b)
    n, m = (sum(c for at, (c, _) in cells.items() if at % 3 == 0) for cells in (x, y))
    cells = {}
    for at in {*x, *y}:
        (p, u), (q, v) = x.get(at, (0, 0)), y.get(at, (0, 0))
        cells[at] = [p - q, u ^ v]
    differ, again = 0, True
    while again:
        again = False
        for at, (count, digest) in list(cells.items()):
            count, digest = cells[at]
            places = _places(digest) if abs(count) == 1 else []
            if at in places:
                for other in places:
                    cells.setdefault(other, [0, 0])
                    cells[other][0] -= count
                    cells[other][1] ^= digest
                differ, again = differ + 1, True
    if any(c != [0, 0] for c in cells.values()):
        return None
    common = (n + m - differ) / 2
    return 1.0 if n + m == 0 else common / (n + m - common)


def neighbours(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(k, next_k, n): each id with the next lower one, the lowest with the highest; whether ids repeat.

    Only ids move. They are ranged into partitions, and what joins two
    partitions is a row for each, which is broadcast.
    """
    ids = docs.groupBy("k").agg(F.max(F.char_length("text")).alias("n"), F.count("*").alias("rows"))
    ids = materialize(ids.repartitionByRange("k").withColumn("pid", F.spark_partition_id()), "ids")
    ends = ids.groupBy("pid").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    # One row for each partition: a window over all of them is small.
    by_pid = Window.orderBy("pid")
    last = F.max("hi").over(by_pid.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edge = ends.select("pid", F.coalesce(F.lag("hi").over(by_pid), last).alias("below"))
    lower = F.lag("k").over(Window.partitionBy("pid").orderBy("k"))
    repeats = not ids.where("rows > 1").isEmpty()
    return ids.withColumn("lower", lower).join(F.broadcast(edge), "pid").select("k", F.coalesce("lower", "below").alias("next_k"), "n"), repeats


def _rows(docs: DataFrame, pairs: DataFrame, repeats: bool) -> DataFrame:
    """(k, th, rows, n_chars, edited_sha256, own, edit, next) of each distinct row, dealt by k."""
    # A text has many cells: its partitions are a quarter of the usual, so that their cells stay in memory.
    # Both sides read one exchange of the texts.
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if repeats:
        other = docs.groupBy(F.col("k").alias("next_k")).agg(F.min("text").alias("text"))
        own = docs.groupBy("k", "text").agg(F.count("*").alias("rows")).repartition(n, "k")
    else:
        dealt = docs.repartition(n, "k")
        other = dealt.select(F.col("k").alias("next_k"), "text")
        own = dealt.withColumn("rows", F.lit(1).cast("long"))
    # What follows is cut to the part that can enter the edit before it moves.
    met = pairs.join(other.hint("merge"), "next_k")
    following = met.select("k", F.substring("text", F.lit(1), F.floor(F.col("n") / 2).cast("int")).alias("head"), digests(F.col("text")).alias("next"))
    both = own.hint("merge").join(following.repartition(n, "k"), "k").withColumn("changed", edited(F.col("text"), F.col("head")))
    return both.select("k", F.xxhash64("text").alias("th"), "rows", F.char_length("text").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"), digests(F.col("text")).alias("own"), digests(F.col("changed")).alias("edit"), "next")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, and likenesses to that and to the next document."""
    docs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LOWEST)).alias("k"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    pairs, repeats = neighbours(docs)
    pairs = materialize(pairs, "neighbours")
    near = ["near_edited", "near_next"]
    done, given, wanted = [], docs, pairs
    for level in range(MAX_LEVEL):
        out = _compare(_rows(given, wanted, repeats), level)
        if done:
            out = out.join(failed.select("k", "th"), ["k", "th"], "left_semi")  # noqa: F821
        out = materialize(out, f"compared-{level}")
        done.append(out.where("not left"))
        failed = out.where("left")
        n = failed.count()
        if not n:
            break
        small = F.broadcast if n <= BROADCAST_ROWS else lambda df: df
        again = failed.select("k").distinct()
        wanted = pairs.join(small(again), "k", "left_semi")
        needed = wanted.select("k").union(wanted.select(F.col("next_k").alias("k"))).distinct()
        given = docs.join(small(needed), "k", "left_semi")
    else:
        exact = _exactly(_rows(given, wanted, repeats)).join(failed.drop(*near), ["k", "th"])
        done.append(materialize(exact.select(*failed.columns), "exact"))
    release(pairs)
    result = reduce(DataFrame.union, done)
    if repeats:
        result = result.withColumn("rows", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    key = F.when(F.col("k") != _LOWEST, F.col("k"))
    return result.select(key.alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(documents(spark, sf_dir).select("doc_id", "text"))
