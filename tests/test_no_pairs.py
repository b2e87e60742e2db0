"""These queries make no table of the pairs before the cap."""

import pytest

from tessera.operators import blocking
from tessera.plans import queries

NAMES = [
    "best_threshold",
    "blocking_recall",
    "candidate_counts",
    "candidates_wide",
    "dedupe_union",
    "label_counts",
    "flag_features",
    "macro_f05",
    "label_join",
    "match_lists",
    "needed_entities",
    "name_cosine",
    "name_jaccard",
    "quick_ratio",
    "seq_ratio",
    "tfidf_idf",
    "threshold_sweep",
]


@pytest.mark.parametrize("name", NAMES)
def test_no_pairs_before_the_cap(spark, monkeypatch, name):
    def refuse(*args):
        raise AssertionError("a row for each pair")

    monkeypatch.setattr(blocking, "blocking_pairs", refuse)
    queries.QUERIES[name](spark, "/root/testdata/sf0.001").schema
