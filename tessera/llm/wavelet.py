"""Token ids in wavelet matrices, one compressed file for each shard.

A shard holds the ids of consecutive documents in ascending doc_id order. Its
wavelet matrix keeps one bit-plane for each bit of an id, from the highest
down; after each plane the ids are parted stably into those with a 0 and those
with a 1. A directory of counts for every 512 bits makes rank a lookup and a
popcount, so access, count and occurrence lookup touch a few words a plane.

File: 8 bytes magic, 4 bytes header length, a JSON header, then zstd frames at
the offsets that the header names: document ids, token offsets, and for each
plane its bits and its directory.

Files are written by the tasks with pyarrow's file systems below the shared
folder, under a temporary name and then renamed, so that a task that is run
again or twice leaves one whole file; they are read with Spark's binaryFile.

Defined results: a null text is empty and has the end id only. A row without
doc_id comes first. Rows that share a doc_id are ordered by text. An empty
table writes no file and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.encoding import default_tokenizer, encoder, text_slices
from tessera.llm.hashing import settle
from tessera.llm.native import documents, text_or_empty
from tessera.workspace import new_path, small_batches

END_ID = 2
SHARD_TOKENS = 1 << 20
MAGIC = b"WAVELET1"
_BLOCK = 512
_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class WaveletMatrix:
    """A sequence of integers as bit-planes with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.ranks, self.zeros = n, planes, ranks, zeros

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, ranks, zeros = [], [], []
        x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for b in range(bits - 1, -1, -1):
            bit = (x >> b) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (_BLOCK // 8), np.uint8)])
            per = _POP[packed].reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint32)
            planes.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(per)]).astype(np.uint32))
            low = x[~bit]
            zeros.append(len(low))
            x = np.concatenate([low, x[bit]])
        return cls(len(ids), planes, ranks, zeros)

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3] >> (i & 7)) & 1

    def _rank1(self, k: int, i: int) -> int:
        """Ones before position i of plane k."""
        block = i // _BLOCK
        count = int(self.ranks[k][block]) + int(_POP[self.planes[k][block * (_BLOCK // 8) : i >> 3]].sum())
        return count + (int(_POP[self.planes[k][i >> 3] & ((1 << (i & 7)) - 1)]) if i & 7 else 0)

    def _select(self, k: int, j: int, one: bool) -> int:
        """The position of the j-th (from 0) one or zero of plane k."""
        r = self.ranks[k].astype(np.int64)
        r = r if one else np.arange(len(r)) * _BLOCK - r
        block = int(np.searchsorted(r, j, side="right")) - 1
        bits = np.unpackbits(self.planes[k][block * 64 : block * 64 + 64], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(bits == int(one))[j - int(r[block])])

    def access(self, i: int) -> int:
        v = 0
        for k in range(len(self.planes)):
            b = self._bit(k, i)
            ones = self._rank1(k, i)
            i = self.zeros[k] + ones if b else i - ones
            v = v << 1 | b
        return v

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            s1, e1 = self._rank1(k, start), self._rank1(k, end)
            if value >> (len(self.planes) - 1 - k) & 1:
                start, end = self.zeros[k] + s1, self.zeros[k] + e1
            else:
                start, end = start - s1, end - e1
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a value in a range."""
        s, e = self._range(value, start, self.n if end is None else end)
        return e - s

    def locate(self, value: int, j: int) -> int:
        """The position of the j-th (from 0) occurrence of a value; -1 if there are fewer."""
        start, end = self._range(value, 0, self.n)
        if j < 0 or start + j >= end:
            return -1
        i = start + j
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - k) & 1
            i = self._select(k, i - self.zeros[k] if one else i, bool(one))
        return i

    def all(self) -> np.ndarray:
        """Every value in order, from the lowest plane up."""
        x = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            y = np.empty_like(x)
            y[~bit] = x[: self.zeros[k]]
            y[bit] = x[self.zeros[k] :] | x.dtype.type(1 << (len(self.planes) - 1 - k))
            x = y
        return x


def pack_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, bits: int, **extra: int) -> bytes:
    import zstandard

    bits = max(bits, int(ids.max()).bit_length()) if len(ids) else bits
    zip_ = zstandard.ZstdCompressor(level=1).compress
    matrix = WaveletMatrix.build(ids, bits)
    parts = [np.array([d or 0 for d in doc_ids], np.int64), np.array([d is None for d in doc_ids], np.uint8), np.array(counts, np.int64)]
    parts += [x for pair in zip(matrix.planes, matrix.ranks) for x in pair]
    frames = [zip_(p.tobytes()) for p in parts]
    header = json.dumps(extra | {"n": len(ids), "n_docs": len(doc_ids), "bits": bits, "zeros": matrix.zeros, "frames": [len(f) for f in frames]}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *frames])


def open_shard(blob: bytes) -> tuple[dict, list[int | None], np.ndarray, WaveletMatrix]:
    import zstandard

    if blob[:8] != MAGIC:
        raise ValueError("not a wavelet shard")
    at = 12 + int.from_bytes(blob[8:12], "little")
    header, frames = json.loads(blob[12:at]), []
    for size in header["frames"]:
        frames.append(zstandard.ZstdDecompressor().decompress(blob[at : at + size]))
        at += size
    of = np.frombuffer
    doc_ids = [None if gone else d for d, gone in zip(of(frames[0], np.int64).tolist(), of(frames[1], np.uint8))]
    matrix = WaveletMatrix(header["n"], [of(f, np.uint8) for f in frames[3::2]], [of(f, np.uint32) for f in frames[4::2]], header["zeros"])
    return header, doc_ids, of(frames[2], np.int64), matrix


def _uri(folder: str) -> str:
    """A folder of Spark's as pyarrow names it."""
    return "s3" + folder[3:] if folder.startswith(("s3a:", "s3n:")) else folder


def _put(folder: str, name: str, blob: bytes) -> None:
    fs, path = pa.fs.FileSystem.from_uri(_uri(folder))
    part = f"{path}/_{name}-{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(part) as f:
        f.write(blob)
    fs.move(part, f"{path}/{name}")


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, bits: int = 16, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, int]]:
    """Write the shards; (partition, tokens) of each range partition, in order."""
    import pyarrow.fs

    fs, path = pyarrow.fs.FileSystem.from_uri(_uri(folder))
    fs.create_dir(path, recursive=True)
    end = np.array([end_id], np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs  # noqa: F401

        enc, pid = encoder(tokenizer), TaskContext.get().partitionId()
        base = seq = held = 0
        ids, counts, blobs = [], [], []

        def flush() -> None:
            nonlocal base, seq, held, ids, counts, blobs
            if ids:
                _put(folder, f"p{pid:06d}-{seq:06d}.wm", pack_shard(ids, counts, np.concatenate(blobs), bits, pid=pid, base=base))
                base, seq, held, ids, counts, blobs = base + held, seq + 1, 0, [], [], []

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, texts in text_slices(batch.column(1)):
                for key, got in zip(keys[a : a + len(texts)], enc.encode(texts)):
                    n = len(got) + 1
                    if held and held + n > shard_tokens:
                        flush()
                    ids.append(key)
                    counts.append(n)
                    blobs += [got, end]
                    held += n
        flush()
        settle()
        yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([base], pa.int64())], ["pid", "n_tokens"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    parts = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(write, "pid int, n_tokens long")
    with small_batches(docs.sparkSession):
        return sorted((r.pid, r.n_tokens) for r in parts.collect())


def read_shards(spark: SparkSession, folder: str, partitions: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    before, total = {}, 0
    for pid, n in partitions:
        before[pid], total = total, total + n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                header, doc_ids, counts, matrix = open_shard(blob.as_buffer().to_pybytes())
                ids = matrix.all().astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts + (before[header["pid"]] + header["base"])), pa.array(counts), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not total:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder)
    return files.select("content").mapInArrow(read, schema)


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "wavelet")
    return read_shards(spark, folder, write_shards(documents(spark, sf_dir), folder, default_tokenizer()))
