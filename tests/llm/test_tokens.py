import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import media, packing, wavelet
from tessera.llm.encoding import Encoder, default_tokenizer
from tessera.workspace import new_path

from . import fixtures


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_word_cache_equals_whole_text(plain, spark):
    texts = [r[1] or "" for r in fixtures.rows()] + [r.text for r in fixtures.small(spark).collect()]
    rng = random.Random(1)
    pieces = [" ", "\n", "a", "é", "'s", "1", ".", " ", "　", "\x1c", "word", "日本"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(400)]
    got = Encoder(default_tokenizer()).encode(texts)
    assert [g.tolist() for g in got] == [plain(t) for t in texts]


def test_wavelet_matrix_against_list():
    rng = np.random.default_rng(0)
    for n, bits in [(0, 4), (1, 1), (700, 4), (5000, 16)]:
        x = rng.integers(0, 1 << bits, n)
        m = wavelet.WaveletMatrix.build(x, bits)
        assert m.all().tolist() == x.tolist()
        for i in rng.integers(0, n, min(n, 50)).tolist():
            assert m.access(i) == x[i]
            at = np.flatnonzero(x == x[i])
            assert m.count(int(x[i])) == len(at)
            assert m.count(int(x[i]), 0, i) == (x[:i] == x[i]).sum()
            j = int(rng.integers(0, len(at)))
            assert m.locate(int(x[i]), j) == at[j]
            assert m.locate(int(x[i]), len(at)) == -1


@pytest.mark.parametrize("which", ["odd", "small", "empty"])
def test_wavelet_shards(spark, plain, which):
    docs = {"odd": lambda: fixtures.frame(spark), "small": lambda: fixtures.small(spark), "empty": lambda: fixtures.frame(spark, [])}[which]()
    folder = new_path(spark, "w")
    got = sorted(tuple(r) for r in wavelet.read_shards(spark, folder, wavelet.write_shards(docs, folder, default_tokenizer(), shard_tokens=3000)).collect())
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = plain(r.text) + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    if which == "small":
        assert len(os.listdir(folder.removeprefix("file://"))) > 4


def check_packing(rows, texts, plain, capacity):
    by_doc, places = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity
    assert by_doc.keys() == texts.keys()
    for d, pieces in by_doc.items():
        ids = plain(texts[d]) + [0]
        at = 0
        for i, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and 0 < r.length <= capacity and (i == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return len(places), sum(r.length for r in rows)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing(spark, plain, capacity):
    for docs in (fixtures.frame(spark), fixtures.small(spark)):
        rows = packing.pack(docs, capacity=capacity).collect()
        n, tokens = check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, plain, capacity)
        assert n <= tokens / capacity * 1.1 + 1
    assert packing.pack(fixtures.frame(spark, [])).count() == 0


def test_leftovers_meet_as_one_sweep(spark):
    rng = random.Random(3)
    for _ in range(200):
        rows = sorted((rng.randrange(50), rng.randrange(2)) for _ in range(rng.randrange(60)))
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(3))
        stack, want = [], []
        for i, (_, kind) in enumerate(rows):
            if kind == 0:
                stack.append(i)
            elif stack:
                want.append((stack.pop(), i))
        got, counts, left = [], {}, {}
        for part, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            stack, alone = [], []
            for i in range(lo, hi):
                if rows[i][1] == 0:
                    stack.append(i)
                elif stack:
                    got.append((stack.pop(), i))
                else:
                    alone.append(i)
            left[part, 1], left[part, 2] = stack[::-1], alone
        counts = {k: len(v) for k, v in left.items() if v}
        for slots, a, pieces, b, n in packing._meet(counts):
            got += [(left[pieces, 1][b + i], left[slots, 2][a + i]) for i in range(n)]
        assert sorted(got) == sorted(want)


@pytest.mark.parametrize("capacity,lengths", [(100, [100] * 7), (100, [1] * 950), (64, [33] * 20 + [31] * 20), (2048, None), (10, [])])
def test_places_of_lengths(spark, capacity, lengths):
    rng = random.Random(8)
    lengths = [min(capacity, int(rng.paretovariate(0.7) * 20)) for _ in range(1500)] if lengths is None else lengths
    pieces = spark.createDataFrame([(i, 0, 0, n, 7, (i % 3) << 40 | i) for i, n in enumerate(lengths)], packing.PIECES)
    rows = packing.place(pieces, capacity).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in by.values():
        at.sort()
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= capacity
    assert len(by) <= 1.02 * max(-(-sum(lengths) // capacity), sum(2 * n > capacity for n in lengths)) + 1


def test_media_round_trip(spark):
    import hashlib

    docs = fixtures.frame(spark)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    stored = media.encode_text(docs)
    got = {r.doc_id: r for r in media.media_features(stored).collect()}
    assert got.keys() == texts.keys()
    for d, raw in texts.items():
        body = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]))
    blob = {r.doc_id: bytes(r.media) for r in stored.collect()}[60]
    track = media.tracks(blob)[0]
    assert media.payload(blob).startswith(texts[60]) and track["width"] == 24
    keys = media.key_frames(track)
    assert len(keys) == -(-track["sizes"][1] // 25) and all(blob[a : a + n] == media.payload(blob)[i * 25 * 576 :][:576] for i, (a, n) in enumerate(keys))
    seen = media.probe(stored.withColumn("codec_clash", stored.doc_id)).collect()
    assert {r.codec for r in seen} == {"raw "} and media.describe(b"no file")["codec"] is None
    assert media.media_features(media.encode_text(fixtures.frame(spark, []))).count() == 0


def test_walk_of_wide_and_open_boxes():
    import struct

    inner = media._box(b"free", b"abc")
    wide = struct.pack(">I4sQ", 1, b"moov", 16 + len(inner)) + inner
    open_end = struct.pack(">I4s", 0, b"mdat") + b"rest"
    assert [p for p, _, _ in media.boxes(wide + open_end)] == [(b"moov",), (b"moov", b"free"), (b"mdat",)]
    with pytest.raises(ValueError):
        list(media.boxes(struct.pack(">I4s", 99, b"moov")))
