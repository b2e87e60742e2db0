import random

import numpy as np
import pytest

from tessera.llm import ngram_join as nj
from tessera.llm.hashing import word_hashes

from . import fixtures

BLANKS = " \t\n\x0b\x0c\r"


def shingles(text, n):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            if word:
                words.append("".join(x.lower() if "A" <= x <= "Z" else x for x in word))
            word = ""
        else:
            word += c
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows, join):
    sets = {d: shingles(t, join.n) for d, t in rows}
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets, key=lambda d: len(sets[d]))
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if len(x) * join.den < join.num * len(y):
                break
            if x and join.den * len(x & y) >= join.num * len(x | y):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return sorted((d, len(sets[d]), top(d)) for d in sets)


def near_copies(seed, groups=6, copies=25, words=(8, 9, 10, 11, 20, 57, 130, 300)):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice(words))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                k = rng.randrange(len(w))
                w[k : k + rng.randrange(0, 2)] = [f"w{rng.randrange(3000)}"] * rng.randrange(0, 3)
            out.append(" ".join(w))
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("tile,join", [(512, nj.Join()), (4, nj.Join()), (8, nj.Join()), (16, nj.Join(5, 80, 100))])
def test_components_of_near_copies(spark, monkeypatch, tile, join):
    monkeypatch.setattr(nj, "TILE", tile)
    monkeypatch.setattr(nj, "PIVOTS", 3)
    monkeypatch.setattr(nj, "BLOCK", 2)
    rows = near_copies(tile)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in nj.jaccard_components(docs, join, tile=tile).collect()) == brute(rows, join)


def test_components_of_tables(spark):
    for docs in (fixtures.frame(spark), fixtures.small(spark)):
        want = brute([(r.doc_id, r.text) for r in docs.collect()], nj.Join())
        assert sorted(tuple(r) for r in nj.jaccard_components(docs).collect()) == want
    assert nj.jaccard_components(fixtures.frame(spark, [])).count() == 0


def test_rows_of_one_document(spark):
    a, b = fixtures.WORDS, " ".join(f"z{i}" for i in range(30))
    docs = spark.createDataFrame([(5, a), (5, b), (7, b), (9, a), (None, a), (3, None), (3, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in nj.jaccard_components(docs).collect())
    assert got == [(3, 0, 3), (3, 0, 3), (5, 28, 5), (5, 38, 5), (7, 28, 5), (9, 38, 5)]


def test_signatures_of_linked_sets_meet():
    rng = np.random.default_rng(3)
    for join in (nj.Join(), nj.Join(5, 80, 100)):
        e = join.edges()
        for _ in range(3000):
            n = int(rng.integers(1, 120))
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = a[rng.random(len(a)) > rng.choice([0, 0.05, 0.15])]
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, 2 + n // 6))).astype(np.uint64)]))
            same = len(np.intersect1d(a, b))
            if len(b) and same < max(len(a), len(b)) and join.den * same >= join.num * (len(a) + len(b) - same):
                assert len(np.intersect1d(nj.signatures(a, join, e), nj.signatures(b, join, e)))


def test_texts_without_a_common_word_do_not_link(spark):
    a = "a"
    while len(a) < 2048:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, " ".join([a] * 30)), (2, " ".join([b] * 30)), (3, a), (4, b)], "doc_id long, text string")
    assert sorted(tuple(r) for r in nj.jaccard_components(docs).collect()) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 4)]


def test_segments_outnumber_differences():
    for join in (nj.Join(), nj.Join(5, 80, 100)):
        e = join.edges()
        for band in range(25):
            g, spare = join.segments(band)
            a = e[band + 1] - 1
            assert g - spare > join.allowed(a, a * join.den // join.num)


def test_words_of_long_texts_are_cut_nowhere():
    rng = random.Random(2)
    raw = "".join(rng.choice(["ab", "C", " ", "\n", "é", "long" * 9]) for _ in range(900)).encode()
    import tessera.llm.hashing as h

    whole, size = word_hashes([raw], lower=True)[0], h.CHUNK
    try:
        h.CHUNK = 100
        parts = word_hashes([raw, b"", b"x"], lower=True)
    finally:
        h.CHUNK = size
    assert (parts[0] == whole).all() and len(parts[1]) == 0 and len(parts[2]) == 1
    assert len(np.unique(whole)) == len(set(raw.lower().split()))
