"""Media columns: ISO base media files in a binary column.

``probe`` walks the nested boxes of each file, decodes its sample tables and
gives codec, duration and the byte ranges of the key frames. It never touches
the payload. ``wrap`` stores bytes losslessly as an uncompressed video track:
every 576 bytes are a frame of 24 by 24 grey samples of 8 bits, and every
25th frame is listed as a sync sample. ``payload`` gives the bytes back, by
the sample tables.

``probe`` describes the first video track, or the first track if there is none.
Of a fragmented file it gives codec and duration, but no samples, as these are
in the fragments. Tables are not trusted: what would run over its box, or lists
more samples than the file has bytes, or nests deeper than ``MAX_DEPTH``, is no
media file.

Defined results: a null or empty text is one frame of padding. Equal texts
give equal files. Rows without doc_id, and rows that share one, are rows like
others. What is no media file gives nulls from ``probe``. An empty table gives
no rows. Columns with the names of the description are replaced by it, all
others pass through.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.native import documents, text_or_empty
from tessera.workspace import materialize

SIDE = 24
UNIT = SIDE * SIDE
RATE = 25
SYNC_EVERY = 25
CHUNK = 64
MAX_DEPTH = 32
_NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"moof", b"traf", b"mvex"}
_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(data: bytes) -> bytes:
    return data + b"\xff" * ((-len(data)) % UNIT or (0 if data else UNIT))


def wrap(data: bytes) -> bytes:
    """An ISO media file whose only track holds ``data``, a positive multiple of UNIT bytes."""
    n = len(data) // UNIT
    chunks, rest = divmod(n, CHUNK)
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHII", SIDE, SIDE, 0x480000, 0x480000), bytes(4), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 40, -1))
    stsc = ([(1, CHUNK)] if chunks else []) + ([(chunks + 1, rest)] if rest else [])
    syncs = range(1, n + 1, SYNC_EVERY)
    wide = len(data) >= 1 << 31
    n_chunks = chunks + bool(rest)

    def file(at: int) -> tuple[bytes, bytes]:
        offsets = [at + i * CHUNK * UNIT for i in range(n_chunks)]
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, 1)),
            _full(b"stss", struct.pack(f">I{len(syncs)}I", len(syncs), *syncs)),
            _full(b"stsc", struct.pack(">I", len(stsc)), *(struct.pack(">III", a, b, 1) for a, b in stsc)),
            _full(b"stsz", struct.pack(">II", UNIT, n)),
            _full(b"co64" if wide else b"stco", struct.pack(f">I{n_chunks}{'Q' if wide else 'I'}", n_chunks, *offsets)),
        )
        minf = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, n, 0x55C4, 0)), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), _MATRIX, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, RATE, n, 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2))
        top = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2") + _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))
        return top, struct.pack(">I4sQ", 1, b"mdat", len(data) + 16) if wide else struct.pack(">I4s", len(data) + 8, b"mdat")

    top, head = file(0)
    top, head = file(len(top) + len(head))
    return b"".join([top, head, data])


def boxes(data: bytes | memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, first byte of the body, end) of every box, nested ones after their parent."""
    end = len(data) if end is None else end
    if len(path) > MAX_DEPTH:
        raise ValueError("boxes are nested too deep")
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1 and start + 16 <= end:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop < body or stop > end:
            raise ValueError(f"box {kind!r} at {start} runs over its parent")
        yield (*path, kind), body, stop
        if kind in _NESTED:
            yield from boxes(data, body, stop, (*path, kind))
        start = stop


def tracks(data: bytes) -> list[dict]:
    """Codec, time scale, duration and sample tables of each track."""
    out: list[dict] = []
    for path, a, end in boxes(data):
        kind = path[-1]
        if path == (b"moof",) and out:
            out[0]["fragmented"] = True
        if kind == b"trak":
            out.append({"codec": "", "timescale": 0, "duration": 0, "stts": [], "stss": None, "stsc": [], "sizes": (0, 0, None), "chunks": [], "handler": ""})
        if not out or b"trak" not in path:
            continue
        t = out[-1]

        def u32(at: int, n: int = 1) -> tuple[int, ...]:
            if at + 4 * n > end:
                raise ValueError("a table runs over its box")
            return struct.unpack_from(f">{n}I", data, at)

        if kind == b"mdhd":
            t["timescale"], t["duration"] = struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else u32(a + 12, 2)
        elif kind == b"hdlr":
            t["handler"] = bytes(data[a + 8 : a + 12]).decode("latin-1")
        elif kind == b"stsd" and u32(a + 4)[0]:
            t["codec"] = bytes(data[a + 12 : a + 16]).decode("latin-1")
            if t["handler"] == "vide":
                t["width"], t["height"] = struct.unpack_from(">HH", data, a + 40)
        elif kind == b"stts":
            v = u32(a + 8, 2 * u32(a + 4)[0])
            t["stts"] = list(zip(v[::2], v[1::2]))
        elif kind == b"stss":
            t["stss"] = u32(a + 8, u32(a + 4)[0])
        elif kind == b"stsc":
            v = u32(a + 8, 3 * u32(a + 4)[0])
            t["stsc"] = list(zip(v[::3], v[1::3]))
        elif kind == b"stsz":
            each, n = u32(a + 4, 2)
            t["sizes"] = (each, n, None if each else u32(a + 12, n))
        elif kind == b"stz2":
            width, n = data[a + 7], u32(a + 8)[0]
            if width not in (4, 8, 16) or a + 12 + (n * width + 7) // 8 > end:
                raise ValueError("a table runs over its box")
            body = data[a + 12 : a + 12 + (n * width + 7) // 8]
            if width == 16:
                sizes = struct.unpack(f">{n}H", body)
            else:
                sizes = tuple(body) if width == 8 else tuple(x for b in body for x in (b >> 4, b & 15))[:n]
            t["sizes"] = (0, n, sizes)
        elif kind == b"stco":
            t["chunks"] = list(u32(a + 8, u32(a + 4)[0]))
        elif kind == b"co64":
            n = u32(a + 4)[0]
            v = u32(a + 8, 2 * n)
            t["chunks"] = [high << 32 | low for high, low in zip(v[::2], v[1::2])]
    for t in out:
        if t["sizes"][1] > len(data):
            raise ValueError("more samples than bytes")
    return out


def main_track(data: bytes) -> dict:
    """The first video track, or the first of any kind."""
    found = tracks(data)
    return next((t for t in found if t["handler"] == "vide"), found[0])


def samples(track: dict) -> Iterator[tuple[int, int]]:
    """(first byte, size) of every sample, from the tables alone."""
    each, n, sizes = track["sizes"]
    sample, run = 0, 0
    for chunk, at in enumerate(track["chunks"], 1):
        while run + 1 < len(track["stsc"]) and track["stsc"][run + 1][0] <= chunk:
            run += 1
        for _ in range(min(track["stsc"][run][1], n - sample)):
            size = each if sizes is None else sizes[sample]
            yield at, size
            at += size
            sample += 1


def key_frames(track: dict) -> list[tuple[int, int]]:
    where = list(samples(track))
    return where if track["stss"] is None else [where[i - 1] for i in track["stss"]]


def payload(data: bytes) -> bytes:
    """The bytes of all samples of the main track."""
    return b"".join(data[a : a + n] for a, n in samples(main_track(data)))


def describe(data: bytes) -> dict:
    """What ``probe`` stores of a file; nulls if it is none."""
    try:
        fragmented = any(t.get("fragmented") for t in tracks(data))
        t = main_track(data)
        keys = key_frames(t)
        if any(a + n > len(data) for a, n in keys):
            raise ValueError("a sample lies outside the file")
    except (ValueError, struct.error, IndexError):
        return {"codec": None, "duration_s": None, "n_samples": None, "key_frames": None}
    return {"codec": t["codec"], "duration_s": t["duration"] / t["timescale"] if t["timescale"] else None, "n_samples": None if fragmented else t["sizes"][1], "key_frames": None if fragmented else [{"offset": a, "size": n} for a, n in keys]}


_PROBE = pa.struct([("codec", pa.string()), ("duration_s", pa.float64()), ("n_samples", pa.int64()), ("key_frames", pa.list_(pa.struct([("offset", pa.int64()), ("size", pa.int64())])))])


def probe(df: DataFrame, media_col: str = "media") -> DataFrame:
    """``df`` with the file's description (codec, duration_s, n_samples, key_frames) in place of the media column."""

    @F.arrow_udf("codec string, duration_s double, n_samples long, key_frames array<struct<offset:long,size:long>>")
    def look(files: pa.Array) -> pa.Array:
        return pa.array([describe(x.as_py() or b"") for x in files], _PROBE)

    kept = [F.col(f"`{c}`") for c in df.columns if c not in (media_col, *(f.name for f in _PROBE))]
    return df.select(F.struct(*kept).alias("_row"), look(F.col(f"`{media_col}`")).alias("_probe")).select("_row.*", "_probe.*")


def encode_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text as a media file."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, max(1, len(batch)), 512):
                part = batch.slice(a, 512)
                raw = [x.as_buffer().to_pybytes() for x in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([wrap(pad(x)) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text")).mapInArrow(make, "doc_id long, n_bytes long, media binary")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration_s double, key_frames array<struct<offset:long,size:long>>"
_FEATURE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), _PROBE.field("key_frames").type]
_FEATURE_NAMES = [x.split()[0] for x in FEATURES.split(", ")]


def media_features(stored: DataFrame) -> DataFrame:
    """Digests of the payload and the file, and the description, of a stored media table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = blob.as_buffer().to_pybytes()
                seen = describe(data)
                body = payload(data)
                keys = seen["key_frames"]
                ranges = zlib.crc32(b"".join(struct.pack(">QQ", k["offset"], k["size"]) for k in keys))
                feature = f"codec={seen['codec'].strip()};size={SIDE}x{SIDE};samples={seen['n_samples']};duration={seen['duration_s']:.2f};keys={len(keys)};ranges={ranges:08x};mean={sum(body) / len(body):.4f}"
                rows.append((key, n, len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, seen["codec"], seen["duration_s"], keys))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FEATURE_TYPES)], _FEATURE_NAMES)

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(read, FEATURES)


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(materialize(encode_text(documents(spark, sf_dir)), "media"))
