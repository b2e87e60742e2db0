"""Documents with every odd case, and the rows of the small driver table."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, media string"
LINE = "This very line is long enough to count as a repeated line."
WORDS = " ".join(f"w{i}" for i in range(40))


def doubled(n):
    """Two words in which sums of letters times powers of an odd base agree modulo 2**64."""
    a, swap = "a", str.maketrans("ab", "ba")
    while len(a) < n:
        a += a.translate(swap)
    return a, a.translate(swap)


def rows():
    texts = [
        None,
        "",
        " ",
        "\n",
        "  two  spaces\tand tabs \r\n here ",
        "Ünïcödé ÉCOLE straße 日本語 \U0001f600 end",
        "one",
        "one two",
        "one two three",
        LINE,
        f"first\n{LINE}\nlast",
        f"{LINE.upper()}  \n{LINE}",
        f"a\n \t{LINE}",
        f"b\n{LINE}\n{LINE}\nc",
        WORDS,
        WORDS,
        f"prefix here {WORDS} suffix",
        f"{WORDS} {WORDS}",
        "same " * 60,
        "x" * 5000,
        "long text here. " * 4000,
        "Permission is granted\nLicensed under CC BY-NC 4.0.\n",
        "<|endoftext|> don't they'll 123 4567 ,.!? a b",
    ]
    out = [(i * 3, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s10"][i % 4], len(t or ""), "clash") for i, t in enumerate(texts)]
    return [*out, (100_000, WORDS + " tail", "en", "s1", 1, "clash"), (100_001, WORDS.upper(), "en", "s1", 1, "clash")]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, DOCS)


def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
