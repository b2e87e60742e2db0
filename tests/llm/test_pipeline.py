import random
import string
import zlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tessera.llm import langid, ngram_join
from tessera.llm.encoding import default_tokenizer

from . import fixtures
from .test_line_license import brute as brute_lines
from .test_mixing_langid import brute_targets
from .test_ngram_join import brute as brute_groups
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def ids(rows):
    return sorted(r.doc_id for r in rows)


@pytest.mark.parametrize("which", ["small", "odd"])
def test_every_stage_on_its_own_input(spark, which):
    docs = fixtures.small(spark) if which == "small" else fixtures.frame(spark)
    columns = docs.columns
    rows = docs.collect()

    out = cp.identify_language(spark, docs, SF)
    kept = out.collect()
    assert out.columns == columns
    model = langid.train(docs.where(~langid.held_out(langid.F.col("doc_id"))))
    want = {r.doc_id for r in langid.detect(docs, model).collect() if r.lang_pred != "und" and r.score >= cp.MIN_SCORE}
    letters = {r.doc_id for r in rows if any(map(str.isalpha, r.text or ""))}
    assert set(ids(kept)) == want <= letters
    assert len(want) > 0.99 * len(letters) if which == "small" else len(want) >= len(letters) - 3

    docs = spark.createDataFrame(kept, out.schema)
    out = cp.drop_repeated_lines(spark, docs, SF)
    assert out.columns == columns
    lines = out.collect()
    assert sorted((r.doc_id, r.text) for r in lines) == sorted((d, t) for d, _, _, t in brute_lines([(r.doc_id, r.text) for r in kept]))
    assert all(r.n_chars == len(r.text) for r in lines)

    docs = spark.createDataFrame(lines, out.schema)
    out = cp.drop_near_copies(spark, docs, SF)
    assert out.columns == columns
    single = out.collect()
    groups = brute_groups([(r.doc_id, r.text) for r in lines], ngram_join.Join(5, 80, 100))
    assert ids(single) == sorted(d for d, _, least in groups if d == least)

    docs = spark.createDataFrame(single, out.schema)
    out = cp.mix_sources(spark, docs, SF)
    assert out.columns == columns
    mixed = out.collect()
    size = lambda r: len((r.text or "").encode().split())
    sources = sorted({r.source for r in single}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(r) for r in single if r.source == s) for s in sources]
    for s, target in zip(sources, brute_targets(sizes, [1 + i % 3 for i in range(len(sources))])):
        assert abs(sum(size(r) for r in mixed if r.source == s) - target) <= max(size(r) for r in single if r.source == s) + 1

    docs = spark.createDataFrame(mixed, out.schema).dropDuplicates(["doc_id"])
    tokenizer = Tokenizer.from_file(default_tokenizer())
    pieces = cp.pack_sequences(spark, docs, SF).collect()
    check_packing(pieces, {r.doc_id: r.text for r in docs.collect()}, lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids, 2048)


FOREIGN = [
    "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。",
    "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме Облонских.",
    "Litwo, ojczyzno moja, ty jesteś jak zdrowie. Ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Dziś piękność twą w całej ozdobie widzę i opisuję.",
    "Mieleni minun tekevi, aivoni ajattelevi lähteäni laulamahan, saa'ani sanelemahan, sukuvirttä suoltamahan, lajivirttä laulamahan.",
    "x" * 5000,
]


def test_foreign_and_random_texts_are_rejected(spark):
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 10))) for _ in range(n)) for n in (20, 200, 2000, 20000)]
    free = (i for i in range(10**6, 10**7) if zlib.crc32(str(i).encode()) % 4 == 2)  # held out: nothing is learnt from them
    planted = [(next(free), t, "en", "src1", len(t)) for t in FOREIGN + noise]
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
        both = docs.union(spark.createDataFrame(planted, docs.schema))
        kept = {r.doc_id: r.lang for r in cp.identify_language(spark, both, sf).collect()}
        assert [t[:30] for d, t, *_ in planted if d in kept] == []
        known = {r.doc_id: r.lang for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
        held = [d for d in known if zlib.crc32(str(d).encode()) % 4 == 2]
        assert sum(d in kept for d in known) >= 0.99 * len(known) and sum(kept.get(d) == known[d] for d in held) >= 0.97 * len(held)


def test_run_is_its_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]
    docs = fixtures.small(spark)
    for _, stage in cp.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    tokens = sum(len(Tokenizer.from_file(default_tokenizer()).encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    out = cp.run(spark, SF).collect()
    assert sum(r.length for r in out) == tokens
    places: dict = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in places.values():
        at.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(at, at[1:])) and at[0][0] == 0 and sum(at[-1]) <= 2048
