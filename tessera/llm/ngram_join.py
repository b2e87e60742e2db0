"""Exact n-gram Jaccard self-join and its components.

1. One pass turns each text into the set of hashes of its word n-grams. Texts
   with equal sets are one class, known by a 128-bit digest of the set and then
   by a number; all that follows works on classes.
2. Sets of similar size can only meet within a size band or with the next one.
   Two sets of sizes a and b at Jaccard t differ in at most d = (a+b)(1-t)/(1+t)
   n-grams. Hash space is cut into d + 1 + s segments, so two linked sets agree
   in at least s + 1 whole ones. A set leaves its s least populated segments out
   and emits a signature for each of the others: of the segments in which two
   sets agree both leave out the least, by one order, so one is left. With s as
   half of d + 1 these are never empty but by rare chance, and a signature says
   something. Small sets have few segments; they emit the pairs of a prefix of
   their hashes instead, two of which linked sets share. Sets with equal
   signatures form buckets. Buckets of equal members are one.
3. The members of a bucket form a tile; a large bucket is cut into chunks, each
   with a few of its first members, and only what these do not tie together
   meets chunk by chunk. In a tile, hashed bitmaps bound every overlap from
   above: each differing bit is at least one differing n-gram. What the bound
   leaves joins into coarse groups.
4. A small coarse group is one tile. A large one is compared with a few of its
   own classes first, which ties most of it together; what is left is cut into
   tiles by component, size band and hash, and tiles meet unless they are of one
   component or their sizes forbid it. In a tile bit counts come first, then
   exact intersections of the sorted arrays. Of the links found a tile keeps a
   forest, never all pairs.
5. Connected components of the forests give every document its class.

Nothing is sampled or capped: a bucket or group of any size is cut into more
tiles. What is sent to the driver are counts. N-grams are told apart by 64-bit
hashes: a pair of sets of a and b n-grams has one counted as common that is not
with a chance of a * b / 2**64.

Defined results: words are runs of other bytes than blanks, A-Z lower-cased;
a text with fewer words than n has its whole sequence as its one n-gram, and a
null or blank text has none, links with nothing and is its own component. Rows
that share a doc_id are one node. A row without doc_id is no node and is left
out. An empty table gives no rows. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.hashing import lean, mix64, raw_slice, settle, word_hashes
from tessera.llm.native import documents, text_or_empty
from tessera.workspace import materialize, release

#: Members of one side of a tile of bitmaps.
TILE = 512
#: Places of the largest bitmaps.
MAX_BITS = 1 << 13
#: Sets whose linked sets may be this small emit pairs of a prefix.
SMALL = 40
#: Classes that a task remembers as seen.
SEEN = 100_000
#: Classes of a large group that all its others are compared with first.
PIVOTS = 32
#: Bounds of one side of an exact tile: classes, and bytes of their arrays.
EXACT_TILE = 8192
EXACT_BYTES = 40_000_000
#: Rows of a tile whose bit counts are compared at once.
BLOCK = 256
_U = np.uint64
_MUL = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5), _U(0xFF51AFD7ED558CCD))


@dataclass(frozen=True)
class Join:
    """Link sets of ``n``-grams when ``den`` * intersection >= ``num`` * union."""

    n: int = 3
    num: int = 90
    den: int = 100

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """Sorted distinct hashes."""
        if not len(words):
            return words
        n = min(self.n, len(words))
        total = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            total = mix64(total + words[i : len(words) - n + 1 + i] * _MUL[i % 5])
        return np.unique(total)

    def allowed(self, a, b):
        """The most n-grams in which linked sets of these sizes can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def sizes_meet(self, a, b):
        return self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)

    def edges(self) -> list[int]:
        """Least sizes of the bands: half as large again each time."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(max(out[-1] + 1, out[-1] * 3 // 2))
        return out

    def least(self, n: int) -> int:
        """The least size of a set linked to one of n, which is also the least they have in common."""
        return -(-n * self.num // self.den)

    def segments(self, band: int) -> tuple[int, int]:
        """(segments, least populated ones that are left out) of a band."""
        a = self.edges()[band + 1] - 1
        b = a * self.den // self.num
        d = self.allowed(a, b)
        spare = (d + 1) // 2
        return d + 1 + spare, spare


def _bits(shingles: np.ndarray, size: int) -> bytes:
    bits = np.zeros(size, bool)
    bits[(mix64(shingles) & _U(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _bit_size(n: int) -> int:
    return min(MAX_BITS, max(64, 1 << int(n).bit_length()))


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    return int(mix64(shingles * _MUL[0]).sum(dtype=np.uint64).astype(np.int64)), int(mix64(shingles ^ _MUL[1]).sum(dtype=np.uint64).astype(np.int64))


_SETS = "kind int, doc_id long, digest long, check long, n long, bits binary, sigs array<long>"
_SET_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
_SET_NAMES = ["kind", "doc_id", "digest", "check", "n", "bits", "sigs"]


def signatures(shingles: np.ndarray, join: Join, edges: list[int]) -> np.ndarray:
    """The signatures of a set: in its band, in the band below if it can meet sets of that, and of its prefix."""
    n = len(shingles)
    low = join.least(n)
    out = []
    if low <= SMALL and n > 1:
        # Both sets have at least ``low`` n-grams in common, two of them among the first n - low + 2 of each.
        first = np.sort(mix64(shingles ^ _MUL[3]))[: n - low + 2]
        i, j = np.triu_indices(len(first), 1)
        out.append(mix64(first[i] * _MUL[4] + mix64(first[j])))
    band = int(np.searchsorted(edges, n, side="right")) - 1
    for b in [band, band - 1] if low < edges[band] else [band]:
        if n <= SMALL:
            break
        g, spare = join.segments(b)
        seg = (((shingles >> _U(32)) * _U(g)) >> _U(32)).astype(np.int64)
        counts = np.bincount(seg, minlength=g)
        sums = np.zeros(g, np.uint64)
        at = np.flatnonzero(counts)
        sums[at] = np.add.reduceat(mix64(shingles ^ _MUL[2]), (np.cumsum(counts) - counts)[at])
        strong = np.argsort(counts, kind="stable")[spare:]
        out.append(mix64(sums[strong] + mix64(strong.astype(np.uint64) + _U(b << 44))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_sets(docs: DataFrame, join: Join, id_col: str, text_col: str) -> DataFrame:
    """Of each text kind 0, its class; kind 1 has the bitmap and signatures of a class, seldom twice in a task."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        edges = join.edges()
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary())
            for lo in range(0, len(ids), 500):
                rows, counts, sigs = [], [], []
                if len(seen) > SEEN:
                    seen.clear()
                for key, words in zip(ids[lo : lo + 500], word_hashes(raw_slice(texts, lo, 500), lower=True)):
                    s = join.shingles(words)
                    digest, check = _digest(s) if len(s) else (0, 0)
                    rows.append((0, key, digest, check, len(s), None))
                    counts.append(0)
                    if len(s) and (digest, check) not in seen:
                        seen.add((digest, check))
                        rows.append((1, key, digest, check, len(s), _bits(s, _bit_size(len(s)))))
                        sigs.append(signatures(s, join, edges))
                        counts.append(len(sigs[-1]))
                values = np.concatenate(sigs).view(np.int64) if sigs else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(values))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows), _SET_TYPES)), lists], _SET_NAMES)
        settle()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text")).where("doc_id is not null")
    return rows.mapInArrow(make, _SETS)


def buckets(sigs: DataFrame) -> DataFrame:
    """(sig, chunk, whole, members): classes with one signature, in chunks of TILE; single classes are dropped.

    ``sigs`` is dealt by signature and read in order, so a bucket passes
    through one task but never lies in its memory.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig_now, members, chunk = None, [], 0
        rows: list[tuple] = []

        def close(last: bool) -> None:
            nonlocal members, chunk
            if chunk or not last or len(members) > 1:
                if members:
                    rows.append((sig_now, chunk, last and chunk == 0, members))
                chunk += 1
            members = []

        def flush() -> Iterator[pa.RecordBatch]:
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64())))], ["sig", "chunk", "whole", "members"])
                rows.clear()

        for batch in batches:
            sig, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(sig):
                continue
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(sig))
            alone = (ends - starts == 1).tolist()
            last = len(starts) - 1
            for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
                if alone[k] and 0 < k < last:
                    continue
                if sig_now is None or sig[a] != sig_now:
                    close(True)
                    sig_now, members, chunk = int(sig[a]), [], 0
                for x in node[a:b].tolist():
                    if not members or members[-1] != x:
                        members.append(x)
                        if len(members) > TILE:
                            rest = members.pop()
                            close(False)
                            members = [rest]
            yield from flush()
        close(True)
        yield from flush()

    dealt = sigs.select("sig", "node").repartition("sig").sortWithinPartitions("sig", "node")
    return dealt.mapInArrow(group, "sig long, chunk int, whole boolean, members array<long>")


def bucket_tiles(found: DataFrame) -> DataFrame:
    """(tile, node): whole buckets, equal ones once, and chunks of larger ones with the first members."""
    whole = found.where("whole").select("members").distinct().select(F.xxhash64("members").alias("tile"), F.explode("members").alias("node"))
    parts = found.where("not whole")
    pivots = parts.where("chunk = 0").select("sig", F.slice("members", 1, PIVOTS).alias("pivots"))
    met = parts.join(pivots, "sig").select(F.xxhash64("sig", "chunk"), F.explode(F.array_union("members", "pivots")))
    return whole.union(met)


def _fold(bits: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of several widths folded to ``size``, as a float matrix."""
    return np.stack([np.unpackbits(np.frombuffer(x, np.uint8)).reshape(-1, size).any(axis=0) for x in bits]).astype(np.float32)


def _bounded(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, join: Join) -> np.ndarray:
    """Pairs that sizes and bit counts leave possible."""
    differ = x.sum(axis=1)[:, None] + y.sum(axis=1)[None, :] - 2 * (x @ y.T)
    return join.sizes_meet(nx[:, None], ny[None, :]) & (differ <= join.allowed(nx[:, None], ny[None, :]) + 0.5)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a symmetric matrix joins."""
    left, out = np.ones(len(linked), bool), []
    for i in range(len(linked)):
        if not left[i]:
            continue
        left[i], front = False, [i]
        while len(front):
            near = np.flatnonzero(linked[front].any(axis=0) & left)
            left[near] = False
            out += [(i, int(j)) for j in near]
            front = near
    return out


def coarse_links(tiles: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """(a, b): forests over what the bitmaps leave in each bucket tile."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            out: list[tuple[int, int]] = []
            for rows in batch.column(0):
                nodes, first = np.unique(rows.values.field("node").to_numpy(), return_index=True)
                n = rows.values.field("n").to_numpy()[first]
                bits = [rows.values.field("bits")[i].as_py() for i in first.tolist()]
                x = _fold(bits, 8 * min(map(len, bits)))
                out += [(int(nodes[i]), int(nodes[j])) for i, j in _forest(_bounded(x, x, n, n, join))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
        settle()

    met = tiles.join(classes, "node").groupBy("tile").agg(F.collect_list(F.struct("node", "n", "bits")).alias("rows"))
    return met.select("rows").mapInArrow(link, "a long, b long").distinct()


def exact_links(sets: DataFrame, join: Join) -> DataFrame:
    """(a, b): forests over the true links of each pair of tiles.

    ``sets`` has (tile, side, node, n, bits, shingles): side 0 is compared with
    itself and side 1, side 1 only with side 0.
    """

    def forest(rows: pa.StructArray) -> list[tuple[int, int]]:
        order = np.argsort(rows.field("n").to_numpy(), kind="stable")
        n, node = rows.field("n").to_numpy()[order], rows.field("node").to_numpy()[order]
        side = rows.field("side").to_numpy()[order]
        at, two = order.tolist(), bool((side == 1).any())
        bits = [rows.field("bits")[i].as_py() for i in at]
        arrays = [np.frombuffer(rows.field("shingles")[i].as_buffer(), np.uint64) for i in at]
        group = np.arange(len(n))
        out: list[tuple[int, int]] = []
        for lo in range(0, len(n), BLOCK):
            hi = min(lo + BLOCK, len(n))
            # Sizes ascend: what a row can link with ends somewhere, and the first row has the smallest bitmap.
            end = int(np.searchsorted(join.num * n, join.den * n[hi - 1], side="right"))
            own = group[lo] if (group[lo:hi] == group[lo]).all() else -1
            others = lo + np.flatnonzero((group[lo:end] != own))
            if not len(others):
                continue
            size = 8 * len(bits[lo])
            x, y = _fold(bits[lo:hi], size), _fold([bits[j] for j in others.tolist()], size)
            maybe = _bounded(x, y, n[lo:hi], n[others], join) & (np.arange(lo, hi)[:, None] < others[None, :])
            if two:
                maybe &= side[lo:hi, None] != side[others][None, :]
            for i in range(lo, hi):
                near = others[maybe[i - lo]]
                for j in near[group[near] != group[i]].tolist():
                    if group[j] == group[i]:
                        continue
                    p, q = arrays[i], arrays[j]
                    same = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                    if join.den * same >= join.num * (len(p) + len(q) - same):
                        group[group == group[j]] = group[i]
                        out.append((int(node[i]), int(node[j])))
        return out

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for rows in batch.column(0):
                out = forest(rows.values)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
        settle()

    met = sets.groupBy("tile").agg(F.collect_list(F.struct("side", "node", "n", "bits", "shingles")).alias("rows"))
    return met.select("rows").mapInArrow(link, "a long, b long")


def _parts(tile: int) -> Column:
    """Parts of a group of classes, so that each is a side of a tile."""
    return F.ceil(F.greatest(F.count("*") / F.lit(float(tile)), 8 * F.sum("n") / F.lit(float(EXACT_BYTES)))).cast("int")


def group_sizes(groups: DataFrame, tile: int) -> DataFrame:
    """(root, m, parts), written: a join with a table can split a large group, one with an aggregate can't."""
    return materialize(groups.groupBy("root").agg(F.count("*").alias("m"), _parts(tile).alias("parts")), "group-sizes")


def first_tiles(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(node, tile, side) from (node, root, n): small groups whole, large ones against pivots.

    A group within the bounds of a tile is one. A larger one is cut by hash, and
    some PIVOTS of its classes, chosen by hash, join every part: they tie most of
    a dense group together before any two parts have to meet.
    """
    g = groups.join(sizes, "root")
    small = g.where("parts = 1").select("node", F.xxhash64("root").alias("tile"), F.lit(0).alias("side"))
    big = g.where("parts > 1")
    of_part = big.select("node", F.xxhash64("root", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("parts")).cast("int")).alias("tile"), F.lit(1).alias("side"))
    chosen = big.where(F.pmod(F.xxhash64(F.lit(4), "node"), F.ceil(F.col("m") / PIVOTS)) == 0)
    pivots = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("node", F.xxhash64("root", "part"), F.lit(0))
    return small.union(of_part).union(pivots)


def rest_tiles(groups: DataFrame, sizes: DataFrame, tied: DataFrame, join: Join, tile: int) -> DataFrame | None:
    """(node, tile, side): what the pivots left open in large groups; None if there are no large ones.

    Classes that are tied to many others are chunked by component, the others
    together; both by fine size bands and hash. Two chunks meet unless they are
    of one component or their sizes forbid a link.
    """
    ratio = float(np.log(join.den / join.num))
    large = sizes.where("parts > 1").select("root", "m")
    if large.isEmpty():
        return None
    g = groups.join(large, "root").join(tied.select("node", F.col("root").alias("c")), "node", "left").withColumn("c", F.coalesce("c", "node"))
    g = materialize(g, "large-groups")
    many = materialize(g.groupBy("root", "c").agg((8 * F.count("*") >= F.first("m")).alias("many")).where("many"), "many")
    g = g.join(many, ["root", "c"], "left").withColumn("c", F.when(F.col("many"), F.col("c")))
    g = g.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int"))
    parts = g.groupBy("root", "c", "band").agg(_parts(tile).alias("parts"))
    cut = materialize(parts.select(F.col("root").alias("r"), F.col("c").alias("cc"), F.col("band").alias("b"), "parts"), "parts")
    g = g.join(cut, (g.root == F.col("r")) & g.c.eqNullSafe(F.col("cc")) & (g.band == F.col("b")))
    part = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("parts")).cast("int")
    g = g.select("node", "root", "c", "n", F.xxhash64("root", F.coalesce("c", F.lit(0).cast("long")), F.col("c").isNull(), "band", part).alias("chunk"))
    g = materialize(g, "chunks")
    chunks = materialize(g.groupBy("root", "chunk").agg(F.first("c").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi")), "chunk-sizes")
    a, b = (chunks.select("root", *[F.col(x).alias(f"{x}_{s}") for x in ("chunk", "c", "lo", "hi")]) for s in "ab")
    same = F.col("c_a").isNotNull() & (F.col("c_a") == F.col("c_b"))
    meet = (join.den * F.col("hi_a") >= join.num * F.col("lo_b")) & (join.den * F.col("hi_b") >= join.num * F.col("lo_a"))
    pairs = a.join(b, "root").where((F.col("chunk_a") <= F.col("chunk_b")) & ~F.coalesce(same, F.lit(False)) & meet)
    pairs = pairs.select("chunk_a", "chunk_b", F.xxhash64("chunk_a", "chunk_b").alias("tile"))
    sides = pairs.select("tile", F.col("chunk_a").alias("chunk"), F.lit(0).alias("side")).union(pairs.where("chunk_a <> chunk_b").select("tile", "chunk_b", F.lit(1)))
    return g.select("node", "chunk").join(sides, "chunk").select("node", "tile", "side")


def coarse_groups(classes: DataFrame, join: Join) -> DataFrame:
    """(node, root): classes that may link, by their signatures and bitmaps; others have no row."""
    sigs = classes.select(F.explode("sigs").alias("sig"), "node")
    slim = classes.select("node", "n", "bits")
    found = materialize(buckets(sigs), "buckets")
    coarse = materialize(coarse_links(bucket_tiles(found), slim, join), "coarse")
    roots = components(coarse)
    # What the pivots of a large bucket did not tie together meets, unless something else did.
    spread = found.where("not whole").select(F.col("sig").alias("root"), F.explode("members").alias("node")).distinct().join(classes.select("node", "n"), "node")
    spread = materialize(spread, "large-buckets")
    sizes = group_sizes(spread, TILE)
    rest = rest_tiles(spread, sizes, roots, join, TILE)
    if rest is not None:
        more = materialize(coarse_links(rest.select("tile", "node"), slim, join), "more-coarse")
        if not more.isEmpty():
            roots = components(coarse.union(more))
    release(found, spread)
    return roots


def classes_and_links(docs: DataFrame, join: Join, id_col: str = "doc_id", text_col: str = "text", tile: int = EXACT_TILE) -> tuple[DataFrame, DataFrame]:
    """(members, links): (doc_id, node, n) of every document, and a forest (a, b) over linked nodes."""
    sets = materialize(shingle_sets(docs, join, id_col, text_col), "sets", "kind")
    one = sets.where("kind = 1").groupBy("digest", "check").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("sigs").alias("sigs"))
    classes = materialize(one.withColumn("node", F.monotonically_increasing_id()), "classes")
    release(sets, part="/kind=1")
    groups = materialize(coarse_groups(classes, join).join(classes.drop("sigs"), "node"), "groups")

    # One text of each class that is in a group is read again for its exact array.
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(5).cast(pa.binary())
            for lo in range(0, len(texts), 256):
                part = batch.slice(lo, 256)
                got = [join.shingles(w) for w in word_hashes(raw_slice(texts, lo, 256), lower=True)]
                # A doc_id may have several texts.
                own = pa.array([len(s) > 0 and _digest(s) == (d, c) for s, d, c in zip(got, part.column(3).to_pylist(), part.column(4).to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([s.tobytes() for s in got], pa.binary())], ["node", "n", "bits", "shingles"]).filter(own)
        settle()

    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("rep"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    needed = groups.select("rep", "node", "n", "bits", "digest", "check").join(text.hint("merge"), "rep").select("node", "n", "bits", "digest", "check", "text")
    exact = materialize(needed.mapInArrow(arrays, "node long, n long, bits binary, shingles binary"), "arrays")
    own = groups.select("node", "root", "n")
    sizes = group_sizes(own, tile)
    links = materialize(exact_links(first_tiles(own, sizes).join(exact, "node"), join).distinct(), "first-links")
    if not sizes.where("parts > 1").isEmpty():
        rest = rest_tiles(own, sizes, components(links), join, tile)
        links = links.union(materialize(exact_links(rest.join(exact, "node"), join).distinct(), "rest-links"))
    members = sets.where("kind = 0").select("doc_id", "digest", "check", "n")
    members = members.join(classes.select("digest", "check", "node").hint("merge"), ["digest", "check"], "left").select("doc_id", "node", "n")
    members = materialize(members, "members")
    release(sets, classes, groups, exact)
    return members, links


def jaccard_components(docs: DataFrame, join: Join | None = None, id_col: str = "doc_id", text_col: str = "text", tile: int = EXACT_TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row with a doc_id."""
    members, links = classes_and_links(docs, join or Join(), id_col, text_col, tile)
    # Rows of one doc_id with several texts are one node: their classes are linked too.
    own = members.where("n > 0").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id", "a")
    own = materialize(own, "several")
    if not own.isEmpty():
        links = links.union(materialize(members.where("n > 0").join(own, "doc_id").where("a <> node").select("a", F.col("node").alias("b")), "own-links"))
    roots = components(links)
    # By class, so that the copies of a class are summed up before they move.
    least = members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = materialize(least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    of_root = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "least-ids")
    of_node = materialize(named.join(of_root, "root").select("node", "component_id"), "components")
    out = members.join(of_node.hint("merge"), "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))
