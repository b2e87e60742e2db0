"""Substring deduplication over a log-structured fingerprint index.

A window is ``window`` consecutive words. Every window has a minimizer, the
least of the hashes of the ``gram``-word grams inside it, and consecutive
windows with the same minimizer form a unit. Equal windows have equal
minimizers at equal places, so it is enough to compare units with one
minimizer, about one for each (window - gram + 2) / 2 words:

* units with equal spans are equal window by window: all but the first are
  repeated throughout;
* a minimizer with units of different spans is contested. The texts of the
  first units of each span are read again and their windows compared one by
  one.

The index keeps the first unit of every (minimizer, span) in sorted immutable
runs, all dealt to the same buckets. A batch is dealt and sorted the same way
and merge-joined with each run, which does not move; units that no run holds
become the next run, the others are repeats. ``fanout`` runs of a level are
merged bucket by bucket into one of the next. What is in the index counts as
earlier than the batch. Batches go in by ascending doc_id.

A unit is known by 128 bits: the hash of its minimizer, made of the hashes of
words, and a cryptographic digest of the words of its whole span, by which a
match is verified; so is a contested window. It is dealt by both, so the
contexts of a common phrase are spread. A task first drops the repeats inside
what it has read, so a passage that a third of all documents hold sends one
unit for each task, and the sorted groups are read as streams: no group lies in
memory.

Defined results: words are runs of other bytes than blanks, unchanged; a null
or blank text has none. A window is repeated if its words also start at a
smaller doc_id, or in the same document at an earlier start; rows that share a
doc_id are rows of one document. A row without doc_id is compared with nothing
and loses nothing. An empty table gives no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.hashing import lean, mix64, raw_slice, run_hashes, settle, word_hashes
from tessera.llm.native import documents, text_or_empty
from tessera.workspace import drop_path, dropped_table, materialize, new_path, release, tidy

WINDOW = 20
GRAM = 6
#: Units that a task holds while it drops its own repeats.
HELD_UNITS = 500_000
BATCHES = 5
_U = np.uint64
#: at: start << 24 | windows << 16 | 16 bits of the text's hash.
UNITS = "kind int, mh long, uh long, doc long, at long"
_NAMES, _TYPES = ["mh", "uh", "doc", "at"], [pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _spans(words: list[bytes], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digests of the words of each span."""
    joined = memoryview(b" ".join(words))
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    return np.frombuffer(b"".join([blake2b(joined[a:b], digest_size=8).digest() for a, b in zip(at[starts].tolist(), (at[ends] - 1).tolist())]), "<i8")


@dataclass(frozen=True)
class Windows:
    window: int = WINDOW
    gram: int = GRAM

    def units(self, hashes: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(minimizer hash, span digest, first window, windows) of each unit of a text."""
        n = len(hashes) - self.window + 1
        if n <= 0:
            none = np.empty(0, np.int64)
            return none, none, none, none
        total = run_hashes(hashes, self.gram)
        low = _U((1 << 28) - 1)
        best = (total & ~low) | np.arange(len(total), dtype=np.uint64)
        width, reach = self.window - self.gram + 1, 1
        while reach * 2 <= width:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        best = np.minimum(best[: n], best[width - reach : width - reach + n])
        place = (best & low).astype(np.int64)
        starts = np.flatnonzero(np.diff(place, prepend=-1))
        counts = np.diff(np.append(starts, n))
        spans = _spans(words, starts, starts + counts + self.window - 1)
        # Where the minimizer lies in the span is part of what makes two spans equal.
        return total[place[starts]].view(np.int64), mix64(spans.view(np.uint64) + (place[starts] - starts).astype(np.uint64)).view(np.int64), starts, counts

    def digests(self, words: list[bytes], starts: np.ndarray) -> np.ndarray:
        """Of the windows at ``starts``."""
        return _spans(words, starts, starts + self.window)


def _first_of_equal(batches: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    """For rows (a, b, doc, at, ...) sorted by these: marks of the first row of each (a, b), and of rows strictly later than it."""
    last: tuple[int, ...] | None = None
    for rows in batches:
        a, b, doc, at = rows[:4]
        n = len(a)
        if not n:
            continue
        first = np.ones(n, bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if last is not None:
            first[0] = (a[0], b[0]) != last[:2]
        head = np.maximum.accumulate(np.where(first, np.arange(n), -1))
        carry = head < 0
        head = np.maximum(head, 0)
        head_doc = np.where(carry, last[2] if last else 0, doc[head])
        head_start = np.where(carry, last[3] if last else 0, at[head] >> 24)
        later = ~first & ((doc != head_doc) | (at >> 24 != head_start))
        last = (int(a[-1]), int(b[-1]), int(head_doc[-1]), int(head_start[-1]))
        yield first, later, rows


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)


def _record(kind: int, *cols: np.ndarray) -> pa.RecordBatch:
    n = len(cols[0])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *(pa.array(c, t) for c, t in zip(cols, _TYPES))], ["kind", *_NAMES])


def _local(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Kind 1: the first of equal rows. Kind 2: those later than it, dealt by document."""
    if not held:
        return
    a, b, doc, at = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((at, doc, b, a))
    for _, later, (a, b, doc, at) in _first_of_equal(iter([(a[order], b[order], doc[order], at[order])])):
        # A row at the very place of the first is no repeat; it stays a candidate.
        keep = ~later
        for lo in range(0, len(a), 50_000):
            part = slice(lo, lo + 50_000)
            yield _record(1, *(c[part][keep[part]] for c in (a, b, doc, at)))
            gone = later[part]
            yield _record(2, mix64(doc[part][gone].astype(np.uint64)).view(np.int64), b[part][gone], doc[part][gone], at[part][gone])


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), text.alias("text"))
    return rows.withColumn("th", F.pmod(F.xxhash64("text"), F.lit(65536)).cast("long"))


def batch_units(docs: DataFrame, windows: Windows, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(kind, mh, uh, doc, at): candidates and known repeats of a batch."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held, n = [], 0
        for batch in batches:
            docs_, ths = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            texts = batch.column(1).cast(pa.binary())
            for lo in range(0, len(texts), 512):
                raws = raw_slice(texts, lo, 512)
                for i, (raw, hashes) in enumerate(zip(raws, word_hashes(raws)), lo):
                    if len(hashes) < windows.window:
                        continue
                    mh, uh, starts, counts = windows.units(hashes, raw.split())
                    held.append((mh, uh, np.full(len(mh), docs_[i]), starts << 24 | counts << 16 | ths[i]))
                    n += len(mh)
                if n >= HELD_UNITS:
                    yield from _local(held)
                    held, n = [], 0
        yield from _local(held)
        settle()

    return _text_rows(docs, id_col, text_col).where("doc is not null").select("doc", "text", "th").mapInArrow(make, UNITS)


def contested_windows(contested: DataFrame, corpus: DataFrame, windows: Windows, id_col: str, text_col: str) -> DataFrame:
    """(doc, at): repeated windows among the contested first units (mh, doc, at), compared one by one."""
    asked = contested.withColumn("th", F.expr("at & 65535")).groupBy("doc", "th").agg(F.collect_list(F.struct("mh", "at")).alias("units"))
    text = _text_rows(corpus, id_col, text_col)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, ths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.binary())
            for lo in range(0, len(texts), 512):
                held = []
                for i, raw in enumerate(raw_slice(texts, lo, 512), lo):
                    units = batch.column(3)[i].values
                    mh, at = (units.field(k).to_numpy() for k in range(2))
                    counts = (at >> 16) & 255
                    starts = np.repeat(at >> 24, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    held.append((windows.digests(raw.split(), starts), np.repeat(mh, counts), np.full(len(starts), docs_[i]), starts << 24 | 1 << 16 | ths[i]))
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*held), _TYPES)], _NAMES)
        settle()

    rows = text.hint("merge").join(asked, ["doc", "th"]).select("doc", "th", "text", "units").mapInArrow(expand, "mh long, uh long, doc long, at long")
    dealt = rows.repartition("mh", "uh").sortWithinPartitions("mh", "uh", "doc", "at")

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, gone, rows in _first_of_equal(_columns(b) for b in batches):
            yield pa.RecordBatch.from_arrays([pa.array(rows[2][gone], pa.int64()), pa.array(rows[3][gone], pa.int64())], ["doc", "at"])

    return dealt.mapInArrow(repeats, "doc long, at long")


class SubstringIndex:
    """The runs: ``levels[i]`` holds (table, path) of the runs of level i, each (kind, mh, uh, batch, doc, at)."""

    def __init__(self, spark: SparkSession, windows: Windows | None = None, fanout: int = 4, buckets: int = 0):
        self.spark, self.windows, self.fanout = spark, windows or Windows(), fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]
        self.repeats: list[DataFrame] = []  # of each batch: (doc, at)

    def _runs(self) -> list[tuple[str, str]]:
        return [r for level in self.levels for r in level]

    def _firsts(self, name: str) -> DataFrame:
        return self.spark.table(name).where("kind = 1")

    def _write(self, rows: DataFrame, level: int) -> tuple[str, str]:
        path = new_path(self.spark, f"unit-run-{level}")
        name = "_".join(path.rsplit("/", 2)[1:]).replace("-", "_")
        rows.write.option("compression", "zstd").option("path", path).bucketBy(self.buckets, "mh", "uh").sortBy("mh", "uh").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))
        return name, path

    def add(self, units: DataFrame) -> DataFrame:
        """Merge the units of a batch, from :func:`batch_units`, with the runs; (doc, at) of its repeats, written.

        Contested units are another matter: see :meth:`spans`.
        """
        rows = units.select(*_NAMES, "kind").repartition(self.buckets, "mh", "uh").withColumn("old", F.lit(False))
        for name, _ in self._runs():
            has = self._firsts(name).select("mh", "uh", F.lit(True).alias("has")).hint("merge")
            rows = rows.join(has, ["mh", "uh"], "left").withColumn("old", F.col("old") | F.col("has").isNotNull()).drop("has")

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: list[pa.RecordBatch] = []

            def candidates() -> Iterator[tuple[np.ndarray, ...]]:
                for batch in batches:
                    cols = _columns(batch)
                    passed = cols[4] == 2
                    if passed.any():
                        known.append(_record(2, *(c[passed] for c in cols[:4])))
                    yield tuple(c[~passed] for c in cols)

            for first, later, rows in _first_of_equal(candidates()):
                yield from known
                known.clear()
                old = rows[5].astype(bool)
                yield _record(1, *(c[first & ~old] for c in rows[:4]))
                gone = later | old
                yield _record(2, *(c[gone] for c in rows[:4]))
            yield from known

        number = len(self.repeats)
        # Sorted here, as a join keeps no order but that of its keys.
        merged = rows.select(*_NAMES, "kind", "old").sortWithinPartitions("mh", "uh", "doc", "at").mapInArrow(merge, UNITS).withColumn("batch", F.lit(number))
        name, _ = self._write(merged, 0)
        self.repeats.append(materialize(self.spark.table(name).where("kind = 2").select("doc", "at"), "repeats"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1
        return self.repeats[-1]

    def compact(self, level: int) -> None:
        """Merge the runs of a level into one; their keys differ, and a bucket meets its like without moving."""
        old, self.levels[level] = self.levels[level], []
        rows = self._firsts(old[0][0])
        for name, _ in old[1:]:
            more = self._firsts(name).select("mh", "uh", *[F.col(c).alias(f"_{c}") for c in ("kind", "batch", "doc", "at")]).hint("merge")
            rows = rows.join(more, ["mh", "uh"], "full_outer").select("mh", "uh", *[F.coalesce(c, f"_{c}").alias(c) for c in ("kind", "batch", "doc", "at")])
        self._write(rows, level + 1)
        self._drop(old)

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            dropped_table(self.spark, name)
            drop_path(self.spark, path)

    def drop(self) -> None:
        self._drop(self._runs())
        self.levels = [[]]

    def spans(self, corpus: DataFrame, batch: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(doc, th, spans), written: the repeated windows of a batch, or of all.

        ``corpus`` holds the texts of all that is indexed.
        """
        runs = self.spark.read.schema(f"{UNITS}, batch int").parquet(*[path for _, path in self._runs()]).where("kind = 1")
        several = runs.groupBy("mh").agg(F.min("uh").alias("a"), F.max("uh").alias("b"), F.max("batch").alias("newest")).where("a < b")
        several = materialize((several if batch is None else several.where(F.col("newest") >= batch)).select("mh"), "contested")
        contested = runs.join(several, "mh")
        rest = contested_windows(contested.select("mh", "doc", "at"), corpus, self.windows, id_col, text_col)
        known = self.repeats if batch is None else self.repeats[batch : batch + 1]
        if batch is not None:
            rest = rest.join(runs.where(F.col("batch") == batch).select("doc").distinct(), "doc", "left_semi")
        for rows in known:
            rest = rest.union(rows)
        out = rest.groupBy("doc", F.expr("at & 65535").alias("th")).agg(F.sort_array(F.collect_list(F.expr("at >> 16"))).alias("spans"))
        out = materialize(out, "spans")
        release(several)
        return out


def remove_spans(docs: DataFrame, spans: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words that its spans cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
                words = text.as_buffer().to_pybytes().split()
                n_words.append(len(words))
                if found.is_valid:
                    v = found.values.to_numpy()
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, v >> 8, 1)
                    np.add.at(edges, (v >> 8) + (v & 255) + window - 1, -1)
                    stay = np.cumsum(edges)[:-1] == 0
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    met = _text_rows(docs, id_col, text_col).hint("merge").join(spans, ["doc", "th"], "left")
    return met.select("doc", "text", "spans").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def _edges(docs: DataFrame, key: Column, batches: int) -> list[int]:
    """Ids that end each batch but the last, of about equal batches."""
    if batches < 2:
        return []
    found = docs.select(F.percentile_approx(key, [i / batches for i in range(1, batches)], 10000).alias("e")).first().e
    return sorted(set(found or []))


def dedup_substrings(docs: DataFrame, windows: Windows | None = None, batches: int = BATCHES, fanout: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of all documents, which enter an index in batches of ascending doc_id."""
    spark, windows = docs.sparkSession, windows or Windows()
    index = SubstringIndex(spark, windows, fanout)
    edges = _edges(docs, F.col(f"`{id_col}`").cast("long"), batches)
    batch = F.lit(0)
    for e in edges:
        batch = batch + F.when(F.col("doc") > e, 1).otherwise(0)
    units = materialize(batch_units(docs, windows, id_col, text_col).withColumn("batch", batch), "units", "batch")
    for b in range(len(edges) + 1):
        index.add(units.where(F.col("batch") == b))
        release(units, part=f"/batch={b}")
        tidy(spark)
    release(units)
    spans = index.spans(docs, None, id_col, text_col)
    index.drop()
    release(*index.repeats)
    tidy(spark)
    return remove_spans(docs, spans, windows.window, id_col, text_col)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
