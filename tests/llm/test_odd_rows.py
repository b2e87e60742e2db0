"""Null and repeated ids, empty tables and clashing names, for operators whose own tests lack them."""

import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tessera.llm import langid, licenses, media, packing, wavelet
from tessera.llm.encoding import default_tokenizer
from tessera.workspace import new_path

from . import fixtures

MIT = "Permission is granted."
ROWS = [(None, "a b c", "en"), (None, None, None), (7, "eins zwei", "de"), (7, "eins zwei", "de"), (7, "", "de"), (3, "x\x00y " * 5, "en")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").selectExpr("*", "'s' as source", "1L as n_chars", "5 as media", "6 as length", "7 as row", "8 as score", "9 as `a.b`")


def pairs(rows):
    return sorted(((d, t or "") for d, t, _ in rows), key=str)


def test_media_of_odd_ids(spark, docs):
    got = media.media_features(media.encode_text(docs)).collect()
    assert sorted(((r.doc_id, r.n_bytes) for r in got), key=str) == sorted(((d, len(t.encode())) for d, t in pairs(ROWS)), key=str)
    seen = media.probe(media.encode_text(docs).selectExpr("*", "1 as codec", "2 as `a.b`"))
    assert seen.columns == ["doc_id", "n_bytes", "a.b", "codec", "duration_s", "n_samples", "key_frames"]


def test_media_of_a_driver_table_is_what_its_text_says(spark):
    import hashlib

    for r in media.op1_media_columns(spark, "/root/testdata/sf0.001").join(fixtures.small(spark).select("doc_id", "text"), "doc_id").collect():
        raw = (r.text or "").encode()
        body = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        file = media.wrap(body)
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest()) and file.endswith(body)
        # Frames of 576 bytes at the end of the file, every 25th a key frame.
        frames = [(len(file) - len(body) + 576 * i, 576) for i in range(len(body) // 576)]
        ranges = zlib.crc32(b"".join(struct.pack(">QQ", *k) for k in frames[::25]))
        assert r.feature == f"codec=raw;size=24x24;samples={len(frames)};duration={len(frames) / 25:.2f};keys={len(frames[::25])};ranges={ranges:08x};mean={sum(body) / len(body):.4f}"


def test_hostile_files_are_no_media():
    def nested(n):
        return b"" if not n else media._box(b"moov", nested(n - 1))

    good = media.wrap(media.pad(b"abc"))
    assert media.describe(good)["n_samples"] == 1
    deep = b""
    for _ in range(2000):
        deep = media._box(b"moov", deep)
    assert media.describe(deep)["codec"] is None
    at = good.index(b"stsz") + 12
    assert media.describe(good[:at] + b"\xff" * 4 + good[at + 4 :])["codec"] is None
    # A sound track before the picture.
    trak = good[good.index(b"trak") - 4 :]
    trak = trak[: struct.unpack(">I", trak[:4])[0]]
    sound = trak.replace(b"vide", b"soun").replace(b"raw ", b"twos")
    both = media._box(b"moov", sound, trak) + bytes(8)
    assert [t["handler"] for t in media.tracks(both[: len(both) - 8])] == ["soun", "vide"] and media.main_track(both[: len(both) - 8])["codec"] == "raw "
    assert media.describe(good + media._box(b"moof", b""))["n_samples"] is None


def test_languages_of_odd_ids(spark, docs):
    model = langid.train(fixtures.small(spark))
    out = langid.detect(docs, model)
    assert set(docs.columns) | {"lang_pred"} == set(out.columns)
    assert sorted(((r.doc_id, r.lang_pred == "und") for r in out.collect()), key=str) == sorted(((d, not any(map(str.isalpha, t or ""))) for d, t, _ in ROWS), key=str)
    assert langid.detect(docs.limit(0), model).count() == 0


def test_tokens_of_odd_ids(spark, docs):
    plain = Tokenizer.from_file(default_tokenizer())
    crc = lambda t, end: zlib.crc32(np.array([*plain.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes())
    folder = new_path(spark, "odd")
    got = wavelet.read_shards(spark, folder, wavelet.write_shards(docs, folder, default_tokenizer())).collect()
    order = sorted(pairs(ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.doc_id, r.ids_crc32) for r in sorted(got, key=lambda r: r.start)] == [(d, crc(t, 2)) for d, t in order]
    packed = packing.pack(docs).collect()
    assert sorted(((r.doc_id, r.ids_crc32) for r in packed), key=str) == sorted(((d, crc(t, 0)) for d, t in pairs(ROWS)), key=str)
    wide = wavelet.open_shard(wavelet.pack_shard([1], [2], np.array([70_000, 3], np.uint32), 16))[3]
    assert wide.all().tolist() == [70_000, 3]


def test_licenses_of_odd_ids(spark, docs):
    out = licenses.scan(docs)
    assert out.count() == len(ROWS) and set(docs.columns) <= set(out.columns)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_pipeline_of_odd_and_empty_tables(spark, docs):
    few = docs.select("doc_id", "text", "lang", "source", "n_chars", "media", "a.b" if False else "row")
    for rows, least in ((few, 1), (few.limit(0), 0)):
        out = rows
        for _, stage in cp.STAGES[:-1]:
            got = stage(spark, out, "")
            assert got.columns == rows.columns
            out = spark.createDataFrame(got.collect(), got.schema)
        assert cp.STAGES[-1][1](spark, out, "").count() >= least
    # Rows drawn twice are packed twice.
    twice = few.where("doc_id = 3").union(few.where("doc_id = 3"))
    assert cp.pack_sequences(spark, twice, "").count() == 2
    unknown = few.withColumn("lang", few.lang.substr(1, 0)).where("false").union(few.selectExpr("doc_id", "text", "cast(null as string)", "source", "n_chars", "media", "row"))
    assert cp.identify_language(spark, unknown, "").count() == sum(any(map(str.isalpha, t or "")) for _, t, _ in ROWS)
