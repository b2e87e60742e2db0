import random
import re
import zlib

import numpy as np
import pytest

from tessera.llm import langid, mixing

from . import fixtures


def brute_targets(sizes, weights):
    total, t, open_ = sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        left = total - sum(t[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > 3 * sizes[i]]
        for i in over or open_:
            t[i] = 3.0 * sizes[i] if over else share[i]
        if not over:
            break
        open_ = [i for i in open_ if i not in over]
    return t


def check(rows, texts):
    assert len(rows) == len(texts)
    by: dict = {}
    for r in rows:
        text, source = texts[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(source, []).append(r)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in by[s]) for s in order]
    targets = brute_targets(sizes, [1 + i % 3 for i in range(len(order))])
    for s, size, target in zip(order, sizes, targets):
        assert {r.source_size for r in by[s]} == {size}
        assert all(r.target == pytest.approx(target) for r in by[s])
        longest = max(r.size for r in by[s])
        assert abs(sum(r.taken for r in by[s]) - target) <= longest + 1


@pytest.mark.parametrize("blocks", [2, 1024])
def test_mix_meets_targets(spark, monkeypatch, blocks):
    monkeypatch.setattr(mixing, "BLOCKS", blocks)
    for docs in (fixtures.frame(spark), fixtures.small(spark)):
        keyed = mixing.keyed(docs, 17)
        rows = mixing.draws(keyed, mixing.plan_mix(keyed))
        n = mixing.F
        out = rows.select("_row.doc_id", n.col("_size").alias("size"), "source_size", "target", (n.col("_size") * n.coalesce(n.size("_draws"), n.lit(0))).alias("taken"))
        got = out.collect()
        check(got, {r.doc_id: (r.text, r.source) for r in docs.collect()})
        assert sorted(got) == sorted(out.collect())


def test_mix_rows_are_the_draws(spark):
    docs = fixtures.small(spark)
    keyed = mixing.keyed(docs, 17)
    plan = mixing.plan_mix(keyed, shards=5)
    want = {r._row.doc_id: len(r._draws or []) for r in mixing.draws(keyed, plan).collect()}
    got: dict = {}
    mixed = mixing.mix(docs, shards=5)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in want.items() if n}
    assert mixing.mix(fixtures.frame(spark, []), shards=5).count() == 0


def test_shards_are_written_in_order(spark):
    docs = fixtures.small(spark)
    keyed = mixing.keyed(docs, 17)
    plan = mixing.plan_mix(keyed, shards=5)
    want: dict = {}
    for r in mixing.draws(keyed, plan).collect():
        for d in r._draws or []:
            want.setdefault(d.shard, []).append(r._row.doc_id)
    parts = [[r.doc_id for r in part] for part in mixing.mix(docs, shards=5).rdd.glom().collect()]
    assert [sorted(p) for p in parts] == [sorted(want.get(i, [])) for i in range(5)] and all(parts)
    assert mixing.plan_mix(keyed, shards=None).shards == 1


def test_mix_of_odd_ids(spark):
    rows = [(None, "a b", None), (None, "c", "x"), (1, "a", "x"), (1, "b c", "x"), (2, None, "y"), (3, "", "y"), (4, " ".join("z" * 9), "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs).collect()
    assert {tuple(r) for r in mixed} <= set(rows) and all(mixed.count(r) <= 3 for r in mixed)
    keyed = mixing.keyed(docs, 17)
    assert sorted((r.source or "~", r.target) for r in mixing.plan_mix(keyed).blocks.select("source", "target").distinct().collect()) == sorted(zip("wxy~", brute_targets([9, 4, 0, 2], [1, 2, 3, 1])))
    assert mixing.draws(mixing.keyed(fixtures.frame(spark, []), 17), mixing.plan_mix(mixing.keyed(fixtures.frame(spark, []), 17))).count() == 0


def test_big_draws_keep_their_bounds():
    rng = np.random.default_rng(1)
    for good, bad, n in [(10**9, 5, 10**9), (3 * 10**9, 10**9, 10**6), (10**9, 10**10, 0)]:
        assert max(0, n - bad) <= mixing._draw(rng, good, bad, n) <= min(good, n)


def test_splitting_tree_keeps_quotas():
    for n in (1, 5, 32):
        quotas = np.array([0, 1, 17, 4000])
        out = mixing.split_quotas(quotas, n, 3)
        assert out.sum(axis=0).tolist() == quotas.tolist() and (out >= 0).all()
        assert np.ptp(out.sum(axis=1)) <= n


def test_presence_against_sets():
    rng = random.Random(0)
    texts = ["", "a", "Ab  c", "x1y--z\n\nÉté", "\U0001f600 a\0b", *("".join(rng.choice("abcdé ,\n") for _ in range(50)) for _ in range(20))]
    together = langid.presence(texts)
    for t, row in zip(texts, together):
        assert (langid.presence([t])[0] == row).all()
        norm = re.sub(" +", " ", "".join(c if c.isalpha() or ord(c) > 0xFFFF else " " for c in f" {t.lower()} "))
        grams = {norm[i : i + n] for n in (1, 2, 3) for i in range(len(norm) - n + 1)}
        if "\0" not in t:
            assert len(grams) * 0.9 - 1 <= row.sum() <= len(grams)


@pytest.mark.parametrize("marks", [6, 2048])
def test_kernel_and_ridge_against_plain_sums(monkeypatch, marks):
    monkeypatch.setattr(langid, "MAX_LANDMARKS", marks)
    monkeypatch.setattr(langid, "BATCH", 7)
    rng = random.Random(1)
    letters = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "mnopqrsa"}
    langs = [x for x in letters for _ in range(11)]
    texts = ["".join(rng.choice(letters[x] + " ") for _ in range(60)) for x in langs]
    seen = ["".join(rng.choice("abcdefghijklmnopqrs ") for _ in range(60)) for _ in range(9)]
    model = langid.fit(np.packbits(langid.presence(texts), axis=1), langs, landmarks=4)
    values, share = model.look(np.packbits(langid.presence(seen), axis=1))

    def places(t):
        return set(np.flatnonzero(langid.presence([t])[0]).tolist())

    def kernel(xs, ys):
        return np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in map(places, ys)] for a in map(places, xs)])

    each = min(4, marks // 3)
    chosen = [t for x in letters for t in [t for t, lang in zip(texts, langs) if lang == x][:each]]
    assert len(model.landmarks) == len(chosen) == 3 * each
    own, all_ = kernel(chosen, chosen), kernel(texts, chosen)
    signs = np.array([[1.0 if lang == x else -1.0 for x in letters] for lang in langs])
    weights = np.linalg.solve(all_.T @ all_ + langid.RIDGE * own, all_.T @ signs)
    k = kernel(seen, chosen)
    assert values == pytest.approx(k @ weights, abs=1e-4)
    assert share == pytest.approx(np.einsum("ij,ij->i", k, np.linalg.solve(own, k.T).T), abs=1e-4)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.op3_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(out) == len(lang)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_language_odd_rows(spark):
    docs = fixtures.frame(spark).withColumnRenamed("media", "score")
    got = {r.doc_id: r for r in langid.detect(docs, langid.train(docs)).collect()}
    assert len(got) == docs.count()
    for d, r in got.items():
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert langid.train(docs.where("lang is null")) is None
    assert {r.lang_pred for r in langid.detect(docs, None).collect()} == {"und"}
    assert langid.detect(fixtures.frame(spark, []), None).count() == 0
