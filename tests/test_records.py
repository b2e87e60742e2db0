"""Records of whole texts: names are found without cutting the text into words, and hold the same words."""

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.plans import fixtures

ODD = ["", " ", "a", " a b ", "\n\nw1 w2\tw3  w4 w5 w6 w7 w8", "w1 w2 w3 w4 w5 w6 w7 w8 ", "1 2 3 4 5 6 7 8 9", " 1 2\n3 4 5 6 7 8 \t 9\n10  11 \n", "x y z", "é ß 日本\x0b& St. a.b.c. q1w2", None]


def _source(spark, tmp_path):
    rows = [(i, t, "en", f"src{i % 20}") for i, t in enumerate(ODD)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return fixtures.source_records(spark, str(tmp_path))


def test_first_eight_words_and_the_rest(spark, tmp_path):
    got = {r.ord: (r.business_name, r.business_address) for r in _source(spark, tmp_path).collect()}
    words = [[w for w in (t or "").replace("\x0b", " ").split() if w] for t in ODD]
    assert got == {i: (" ".join(w[:8]), " ".join(w[8:])) for i, w in enumerate(words)}


def test_names_do_not_cut_whole_texts(spark, tmp_path):
    plan = _source(spark, tmp_path).select("entity_id", "business_name")._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_ascii_texts_take_short_patterns_with_equal_results(spark):
    """What is ASCII once folded gives what the Unicode patterns give."""
    texts = ["A.B.C. Co., Ltd. & Sons\x1f", "Café Straße 12b Rd. St.John", " x_y\x02 \x03dr", "***", "caf́e ², ٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for words in (text.GENERAL, text.ADDRESS):
        long = text.clean(text.expand(text.spell_ampersand(text.join_acronyms(text.fold(F.col("t")))), words))
        rows = df.select(text.normalize(F.col("t"), words, True), F.when(long == "", text.strip(F.col("t"))).otherwise(long)).collect()
        assert all(a == b for a, b in rows)
    assert df.select(text.is_ascii(F.col("t")).alias("a")).where("a").count() == 3
