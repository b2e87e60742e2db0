import hashlib
import re

import pytest
import xxhash

from tessera.llm import fingerprints as fp

from . import fixtures

MASK = (1 << 64) - 1


def digests(text):
    out = set()
    for piece in re.findall(r"[^\n.!?]{1,64}[.!?]*|[.!?]+", text):
        high = xxhash.xxh64_intdigest(piece.encode(), 42) & ~0xFFFFF & MASK
        out.add(high | xxhash.xxh64_intdigest(high.to_bytes(8, "little"), 42) & 0xFFFFF)
    return out


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    texts = {}
    for d, t in rows:
        k = -(1 << 63) if d is None else d
        texts[k] = min(texts.get(k, t or ""), t or "")
    order = sorted(texts, reverse=True)
    after = {k: texts[order[(i + 1) % len(order)]] for i, k in enumerate(order)}
    out = []
    for d, t in rows:
        t, nxt = t or "", after[-(1 << 63) if d is None else d]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(digests(t), digests(e)), likeness(digests(t), digests(nxt)), t, e))
    return sorted(out, key=str)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.fingerprint, r.edited_fingerprint) for r in fp.fingerprint(docs).collect()), key=str)
    want = brute(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    seen: dict = {}
    for g, w in zip(got, want):
        assert g[3:5] == pytest.approx(w[3:5])
        for f, text in ((g[5], w[5]), (g[6], w[6])):
            key = frozenset(digests(text))
            assert seen.setdefault(key, f) == f and len(f) <= 26 * 24
        told = fp.likeness(g[5], g[6])
        assert told is None or told == pytest.approx(w[3])
    assert len(set(seen.values())) == len(seen)
    # Few digests can always be told apart by the fingerprints alone.
    assert all(fp.likeness(g[5], g[6]) is not None for g, w in zip(got, want) if len(digests(w[5]) ^ digests(w[6])) <= 4)


def test_differing_digests_are_recovered(spark):
    for docs in (fixtures.small(spark).select("doc_id", "text"), fixtures.frame(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got: dict = {}
        for r in fp.differences(docs).collect():
            got.setdefault((r.doc_id, r.against, r.side), set()).add(r.digest & MASK)
        want = {}
        nexts = {k: v for k, v in zip(sorted((d for d, _ in rows), reverse=True), [*sorted((d for d, _ in rows), reverse=True)[1:], max(d for d, _ in rows)])}
        texts = {d: t or "" for d, t in rows}
        for d, *_, t, e in brute(rows):
            for against, other in (("edit", e), ("next", texts[nexts[d]])):
                a, b = digests(t), digests(other)
                want |= {(d, against, side): x for side, x in (("own", a - b), ("other", b - a)) if x}
        assert all(want[k] == v for k, v in got.items()) and len(got) > 0.9 * len(want)


def test_exact_comparison_after_the_last_size(spark, monkeypatch):
    real = fp._peel
    monkeypatch.setattr(fp, "MAX_LEVEL", 1)
    monkeypatch.setattr(fp, "_peel", lambda cells, level, rounds=1: real(cells, level, 1))
    check(fixtures.small(spark).select("doc_id", "text"))


def test_tables(spark):
    check(fixtures.small(spark).select("doc_id", "text"))
    check(fixtures.frame(spark))
    assert fp.fingerprint(fixtures.frame(spark, [])).count() == 0


def test_one_document_is_its_own_neighbour(spark):
    check(spark.createDataFrame([(4, "One. Two. Three.")], "doc_id long, text string"))


def test_rows_of_one_document(spark):
    w = "A one. B two. C three."
    check(spark.createDataFrame([(1, w), (1, w), (1, "Z. " + w), (None, w), (None, None), (2, w + " More.")], "doc_id long, text string"))


def test_failed_comparisons_are_made_again(spark, monkeypatch):
    docs = fixtures.small(spark).select("doc_id", "text")
    levels = []
    real = fp._peel
    monkeypatch.setattr(fp, "_peel", lambda cells, level, rounds=3: levels.append(level) or real(cells, level, 2 if level == 0 else 12))
    check(docs)
    assert levels == [0, 1]


def test_no_python_in_the_plan(spark):
    docs = fixtures.small(spark).select("doc_id", "text")
    rows = fp._rows(docs.select(docs.doc_id.alias("k"), "text"), fp.neighbours(docs.select(docs.doc_id.alias("k"), "text"))[0], False)
    plan = fp._compare(rows, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
