import hashlib
from pathlib import Path

import pytest

from tessera.llm import licenses, line_dedup
from tests.oracle import compare

from . import fixtures


def brute(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, kept text) by the words of the contract."""
    blanks = " \t\n\x0b\x0c\r"
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    keys = [(d, [lower(x.strip(blanks)) for x in (t or "").split("\n")]) for d, t in rows]
    holders: dict = {}
    for d, ks in keys:
        for k in ks:
            if len(k) >= min_chars and d is not None:
                holders.setdefault(k, set()).add(d)
    out = []
    for (d, t), (_, ks) in zip(rows, keys):
        lines = (t or "").split("\n")
        gone = [d is not None and len(holders.get(k, ())) >= min_docs and d < max(holders[k]) for k in ks]
        out.append((d, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.lines, r.dropped, r.text) for r in df.collect()), key=str)


COUNTS = ("lines", "dropped")


@pytest.mark.parametrize("batches,fanout", [(1, 4), (4, 2), (5, 2)])
def test_lines_against_brute_force(spark, batches, fanout):
    for docs in (fixtures.frame(spark), fixtures.small(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout, counts=COUNTS)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert got(out) == brute(rows)
    assert got(line_dedup.dedup_lines(fixtures.frame(spark, []), counts=COUNTS)) == []


def test_lines_of_odd_rows(spark):
    x = fixtures.LINE
    rows = [(1, x), (1, x), (None, x), (2, x + "\n" + x), (3, "a\n" + x), (4, x), (5, x.replace("T", "t")), (5, "É" * 45), (6, "é" * 45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(line_dedup.dedup_lines(docs, counts=COUNTS)) == brute(rows)


def test_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        docs = spark.createDataFrame([(10 * k + i, f"{fixtures.LINE}\n{i} {fixtures.LINE}") for i in range(3)], "doc_id long, text string")
        runs.add(line_dedup.line_table(docs))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    # Only the run that first held a line names its keeper, the largest id of that batch.
    assert sorted(r.keeper for r in runs.repeated(5).collect()) == [0, 1, 2, 2]
    assert [r.keeper for r in runs._tables()[0].collect()] == [None] * 4
    runs.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("run_")]


def test_clashing_names_pass_through(spark):
    docs = fixtures.frame(spark).selectExpr("*", "7 as lines", "8 as gone", "9 as _n_lines", "10 as h1", "11 as `a.b`")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and {(r.lines, r.gone, r._n_lines, r.h1, r["a.b"]) for r in out.collect()} == {(7, 8, 9, 10, 11)}


def test_lines_and_licenses_against_sql(spark):
    for query, sql in ((line_dedup.op2_line_dedup, line_dedup.OP2_SQL), (licenses.op10_license_scan, licenses.OP10_SQL)):
        assert compare(spark, "/root/testdata/sf0.001", query, sql) == ""


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as digest", "2 as license_id", "3 as n")
    out = licenses.scan(docs)
    assert out.columns == ["doc_id", "text", "digest", "n", "canonical_digest", "n_words", "license_id", "notice_ids"]
    return [(r.license_id, r.notice_ids) for r in sorted(out.collect())]


def test_license_texts(spark):
    mit = licenses.LICENSES["MIT"]
    wrapped = "MIT License\r\n\r\nCopyright (c) 2020 Some One\n© 2021 Another\n\n" + mit.removeprefix("MIT License\n").replace(" ", "\n   ").upper()
    bsd = "Copyright 1999, X. All rights reserved.\n" + licenses.LICENSES["BSD-3-Clause"].replace('"AS IS"', "“as is”")
    zlib_ = licenses.LICENSES["Zlib"].replace("acknowledgment", "acknowledgement")
    notice = "Some words\n** released under the MIT licence **\nLicensed under CC BY-NC 4.0\nReleased under the MIT License."
    assert scan(spark, [mit, wrapped, bsd, zlib_, notice, mit + "\nAnd more.", "", None, "Copyright (c) 2020"]) == [
        ("MIT", ""), ("MIT", ""), ("BSD-3-Clause", ""), ("Zlib", ""), (None, "CC-BY-NC-4.0,MIT"), (None, ""), (None, ""), (None, ""), (None, "")
    ]
    assert licenses.scan(fixtures.frame(spark, [])).count() == 0
    assert licenses.scan(fixtures.frame(spark)).count() == len(fixtures.rows())


def test_common_licenses_and_notices(spark):
    top = Path(licenses.__file__).with_name("known_licenses")
    files = sorted(top.glob("*.txt"))
    assert sorted(map(tuple, licenses.text_digests(spark).distinct().collect())) == sorted(tuple(x.split("\t")) for x in top.with_suffix(".tsv").read_text().splitlines())
    got = scan(spark, ["Copyright (c) 2020 Some One\n" + p.read_text().replace("\n", "\r\n").upper() for p in files])
    assert [x for x, _ in got] == [p.stem.partition("@")[0] for p in files]
    lines = {
        "Licensed under the MIT License": "MIT",
        "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "This program is licensed under the GNU General Public License v2.0.": "GPL-2.0",
        "This work is licensed under a tree.": "",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
        "Released under CC0 1.0\nReleased under the CC0 1.0 Universal License\nlicensed under the EPL 2.0": "CC0-1.0,EPL-2.0",
    }
    assert scan(spark, list(lines)) == [(None, x) for x in lines.values()]


def test_empty_form_matches_nothing(spark):
    known = spark.createDataFrame([("X", hashlib.sha256(b"").hexdigest())], "license_id string, digest string")
    assert licenses.scan(fixtures.frame(spark), known=known).where("license_id is not null").count() == 0


def test_native_plans(spark):
    docs = fixtures.small(spark)
    for df in (licenses.scan(docs), line_dedup.dedup_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
