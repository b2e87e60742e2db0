"""The registered queries in SQL, as common table expressions that build on each other."""

from __future__ import annotations

from tessera.functions.text import ADDRESS, GENERAL
from tessera.operators.model import THRESHOLDS


def _fold(c: str) -> str:
    return f"regexp_replace(replace(lower(strip_accents({c})), 'ß', 'ss'), '^\\s+|\\s+$', '', 'g')"


def _acronyms(c: str) -> str:
    for n in range(8, 1, -1):
        c = "regexp_replace({}, '\\b{}([a-z]?)\\b', '{}', 'g')".format(c, r"([a-z])\." * n, "".join(f"\\{i}" for i in range(1, n + 2)))
    return c


def _expand(c: str, words: dict[str, str]) -> str:
    for k, v in words.items():
        c = f"regexp_replace({c}, '\\b{k}(s?)\\.\\b', '{v}\\1' || chr(1), 'g')"
    for k, v in words.items():
        c = f"regexp_replace({c}, '\\b{k}(s?)\\b', '{v}\\1', 'g')"
    return f"replace({c}, chr(1), '')"


def normalize(c: str, words: dict[str, str]) -> str:
    raw = f"coalesce({c}, '')"
    out = _expand(f"regexp_replace({_acronyms(_fold(raw))}, '\\s*&\\s*', ' and ', 'g')", words)
    out = f"regexp_replace(regexp_replace({out}, '([0-9])([a-z])', '\\1 \\2', 'g'), '([a-z])([0-9])', '\\1 \\2', 'g')"
    out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{Nd}}_²³¹¼½¾]+', ' ', 'g'))"
    return f"CASE WHEN {out} = '' THEN regexp_replace({raw}, '^\\s+|\\s+$', '', 'g') ELSE {out} END"


COUNTRY = "lower(regexp_replace(coalesce({}, ''), '^\\s+|\\s+$', '', 'g'))"

RECORDS = f"""records AS MATERIALIZED (
  SELECT 'd' || doc_id AS entity_id, array_to_string(w[1:8], ' ') AS business_name,
         array_to_string(w[9:], ' ') AS business_address,
         lang AS country, CASE WHEN nr < 8 THEN 1 WHEN nr < 14 THEN 2 ELSE 3 END AS source, doc_id AS ord
  FROM (SELECT *, list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w, CAST(substr(source, 4) AS INT) AS nr FROM documents)),
entities AS MATERIALIZED (
  SELECT *, {normalize("business_name", GENERAL)} AS business_name_clean, {normalize("business_address", ADDRESS)} AS business_address_clean,
         {COUNTRY.format("country")} AS country_clean FROM records)"""
TRUTH = """truth AS (
  SELECT 'd' || a.doc_id AS source1_entity_id, string_agg('d' || b.doc_id, ',' ORDER BY 'd' || b.doc_id) AS matched_entity_ids
  FROM documents a JOIN documents b ON a.text = b.text
  WHERE CAST(substr(a.source, 4) AS INT) < 8 AND CAST(substr(b.source, 4) AS INT) >= 8 GROUP BY 1),
true_pairs AS (SELECT source1_entity_id, trim(unnest(string_split(matched_entity_ids, ','))) AS candidate_entity_id FROM truth)"""
TOKENS = """toks AS MATERIALIZED (
  SELECT country_clean, unnest(list_distinct(list_filter(string_split(business_name_clean, ' '), lambda t: length(t) >= 2))) AS token, entity_id, source, ord FROM entities),
sizes AS (SELECT country_clean, greatest(1, CAST(floor(0.05::DOUBLE * count(*)) AS BIGINT)) AS max_df FROM entities WHERE source <> 1 GROUP BY 1),
dfs AS (SELECT t.country_clean, t.token, count(*) AS df, any_value(s.max_df) AS max_df FROM toks t JOIN sizes s USING (country_clean) WHERE t.source <> 1 GROUP BY 1, 2)"""
PAIRS = """posts AS (
  SELECT t.country_clean, t.token, t.entity_id, d.df FROM toks t JOIN dfs d USING (country_clean, token) WHERE t.source <> 1 AND d.df <= d.max_df
  QUALIFY row_number() OVER (PARTITION BY t.country_clean, t.token ORDER BY t.source, t.ord, t.entity_id) <= 5000),
pairs AS MATERIALIZED (
  SELECT a.entity_id AS source1_entity_id, p.entity_id AS candidate_entity_id, count(*) AS n_shared, min(p.df) AS min_df
  FROM toks a JOIN posts p USING (country_clean, token) WHERE a.source = 1 GROUP BY 1, 2)"""
GRAMS = """words AS (SELECT entity_id, ' ' || unnest(list_filter(string_split(lower(business_name_clean), ' '), lambda x: x <> '')) || ' ' AS w FROM entities),
grams AS MATERIALIZED (
  SELECT entity_id, gram, count(*) AS tf
  FROM (SELECT entity_id, substr(w, i, n) AS gram FROM (SELECT entity_id, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM words, (VALUES (2), (3), (4)) v(n) WHERE length(w) >= n)) GROUP BY 1, 2)"""
SCORED = """norms AS (SELECT entity_id, sqrt(sum(tf * tf)) AS norm FROM grams GROUP BY 1),
capped AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY n_shared DESC, min_df, candidate_entity_id) <= 300),
dots AS (SELECT c.source1_entity_id, c.candidate_entity_id, sum(x.tf * y.tf) AS d FROM capped c JOIN grams x ON x.entity_id = c.source1_entity_id JOIN grams y ON y.entity_id = c.candidate_entity_id AND y.gram = x.gram GROUP BY 1, 2),
scored AS (
  SELECT c.source1_entity_id, c.candidate_entity_id, round(coalesce(d.d / (m.norm * n.norm), 0.0), 6) AS blocking_score
  FROM capped c LEFT JOIN dots d USING (source1_entity_id, candidate_entity_id) LEFT JOIN norms m ON m.entity_id = c.source1_entity_id LEFT JOIN norms n ON n.entity_id = c.candidate_entity_id),
topk AS MATERIALIZED (
  SELECT * FROM scored WHERE blocking_score >= 0.3
  QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY blocking_score DESC, candidate_entity_id) <= 20)"""
LABELLED = """labelled AS MATERIALIZED (
  SELECT k.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label
  FROM topk k LEFT JOIN (SELECT DISTINCT * FROM true_pairs) t USING (source1_entity_id, candidate_entity_id))"""
NEEDED = """needed AS (SELECT * FROM entities WHERE entity_id IN (SELECT source1_entity_id FROM topk UNION SELECT candidate_entity_id FROM topk))"""
IDF = """counts AS (SELECT gram, count(*) AS df, sum(tf) AS total FROM grams WHERE entity_id IN (SELECT entity_id FROM needed) GROUP BY 1 HAVING count(*) >= 2 ORDER BY total DESC, gram LIMIT 500000),
idf AS MATERIALIZED (SELECT gram, df, ln((1.0 + (SELECT count(*) FROM needed)) / (1.0 + df)) + 1.0 AS idf FROM counts)"""
F_BETA = """CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 OR tp = 0 THEN 0.0
  ELSE 1.25 * (tp::DOUBLE / n_pred) * (tp::DOUBLE / n_true) / (0.25 * (tp::DOUBLE / n_pred) + tp::DOUBLE / n_true) END"""
SWEEP = f"""swept AS (
  SELECT threshold, round(avg({F_BETA}), 6) AS macro_f FROM (
    SELECT threshold, source1_entity_id, count(*) FILTER (blocking_score >= threshold AND label = 1) AS tp,
           count(*) FILTER (blocking_score >= threshold) AS n_pred, count(*) FILTER (label = 1) AS n_true
    FROM labelled, (VALUES {", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS)}) v(threshold) GROUP BY 1, 2) GROUP BY 1)"""
_TOPK = (RECORDS, TOKENS, PAIRS, GRAMS, SCORED)
# The same without a cap on postings or on candidates.
WHOLE_PAIRS = PAIRS.replace("\n  QUALIFY row_number() OVER (PARTITION BY t.country_clean, t.token ORDER BY t.source, t.ord, t.entity_id) <= 5000", "")
WHOLE_SCORED = SCORED.replace(" QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY n_shared DESC, min_df, candidate_entity_id) <= 300", "")
_WHOLE = (RECORDS, TOKENS, WHOLE_PAIRS, GRAMS, WHOLE_SCORED)
_LAB = (*_TOPK, TRUTH, LABELLED)
_JACCARD = """CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 1.0
  ELSE len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"""
_WORDS = "list_filter(string_split({}, ' '), lambda x: x <> '')"


def _jaccard(col: str) -> str:
    return _JACCARD.format(a=_WORDS.format(f"a.{col}"), b=_WORDS.format(f"b.{col}"))


def _with(parts: tuple[str, ...], body: str) -> str:
    return f"WITH {', '.join(parts)} {body}"


_SIDES = "FROM topk k JOIN entities a ON a.entity_id = k.source1_entity_id JOIN entities b ON b.entity_id = k.candidate_entity_id"
_CUSTOMERS = f"""parties AS (
  SELECT 'c' || c_custkey AS entity_id, {COUNTRY.format("CAST(c_nationkey AS VARCHAR)")} AS country_clean, c_custkey AS n, 1 AS source FROM customer
  UNION ALL SELECT 's' || s_suppkey, {COUNTRY.format("CAST(s_nationkey AS VARCHAR)")}, s_suppkey, 2 FROM supplier),
met AS (SELECT c.entity_id AS source1_entity_id, c.country_clean AS s1_country, s.entity_id AS candidate_entity_id, s.country_clean AS match_country
        FROM parties c JOIN parties s ON c.n = s.n AND c.source = 1 AND s.source = 2)"""
_QUICK = """least_counts AS (
  SELECT k.source1_entity_id, k.candidate_entity_id, sum(least(x.n, y.n)) AS common
  FROM topk k JOIN chars x ON x.entity_id = k.source1_entity_id JOIN chars y ON y.entity_id = k.candidate_entity_id AND y.c = x.c GROUP BY 1, 2)"""
# The longest common subsequence as the least ends of the increasing runs of places in x, letter by letter of y.
_LCS = f"""sides AS (SELECT source1_entity_id, candidate_entity_id, a.business_name_clean AS x, b.business_name_clean AS y {_SIDES}),
lcs AS MATERIALIZED (
  SELECT x, y, list_reduce(list_transform(string_split(y, ''), lambda c: list_filter(range(1, length(x) + 1), lambda i: substr(x, i, 1) = c)),
    lambda t, p: list_filter(list_transform(range(1, len(t) + 2), lambda k: least(t[k], list_min(list_filter(p, lambda q: q > coalesce(t[k - 1], 0))))), lambda e: e IS NOT NULL),
    []::BIGINT[]) AS t
  FROM (SELECT DISTINCT x, y FROM sides))"""
_CHARS = "chars AS (SELECT entity_id, c, count(*) AS n FROM (SELECT entity_id, unnest(string_split(business_name_clean, '')) AS c FROM entities) WHERE c <> '' GROUP BY 1, 2)"

SQL = {
    "normalize_names": f"SELECT doc_id, {normalize('text', GENERAL)} AS clean FROM documents",
    "normalize_addresses": f"SELECT doc_id, {normalize('text', ADDRESS)} AS clean FROM documents",
    "normalize_country": f"SELECT doc_id, {COUNTRY.format('lang')} AS country_clean, false AS was_transliterated FROM documents",
    "country_counts": _with((RECORDS,), "SELECT source, country_clean, count(*) AS n FROM entities GROUP BY 1, 2"),
    "country_blank_counts": _with((RECORDS,), "SELECT source, count(*) FILTER (country_clean = '') AS n_blank, count(*) AS n FROM entities GROUP BY 1"),
    "gt_country_mismatch": _with((_CUSTOMERS,), "SELECT count(*) FILTER (s1_country IS DISTINCT FROM match_country) AS mismatches, count(*) AS total_pairs, round(100.0 * count(*) FILTER (s1_country IS DISTINCT FROM match_country) / count(*), 6) AS pct, 100.0 * count(*) FILTER (s1_country IS DISTINCT FROM match_country) / count(*) > 2.0 AS warn FROM met"),
    "gt_mismatch_examples": _with((_CUSTOMERS,), "SELECT * FROM met WHERE s1_country IS DISTINCT FROM match_country ORDER BY source1_entity_id, candidate_entity_id LIMIT 10"),
    "token_df": _with((RECORDS, TOKENS), "SELECT * FROM dfs"),
    "common_tokens": _with((RECORDS, TOKENS), "SELECT country_clean, token, df FROM dfs WHERE df > max_df"),
    "blocking_pairs": _with((RECORDS, TOKENS, PAIRS), "SELECT * FROM pairs"),
    "name_cosine": _with(_TOPK, "SELECT * FROM scored"),
    "blocking_topk": _with(_WHOLE, "SELECT * FROM topk"),
    "candidates_wide": _with(_TOPK, "SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(k.candidate_entity_id, ',' ORDER BY k.blocking_score DESC, k.candidate_entity_id), '') AS candidate_entity_ids FROM entities e LEFT JOIN topk k ON k.source1_entity_id = e.entity_id WHERE e.source = 1 GROUP BY 1"),
    "candidate_counts": _with(_WHOLE, "SELECT count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM topk k WHERE k.source1_entity_id = e.entity_id)) AS n_with_any FROM entities e WHERE source = 1"),
    "blocking_recall": _with((*_TOPK, TRUTH), "SELECT count(*) AS n_true, count(k.blocking_score) AS n_found, round(count(k.blocking_score)::DOUBLE / count(*), 6) AS recall FROM (SELECT DISTINCT * FROM true_pairs) t LEFT JOIN topk k USING (source1_entity_id, candidate_entity_id)"),
    "char_ngrams": _with((RECORDS, GRAMS), "SELECT entity_id, gram, tf FROM grams"),
    "gt_explode": _with((TRUTH,), "SELECT * FROM true_pairs"),
    "needed_entities": _with((*_TOPK, NEEDED), "SELECT entity_id, business_name_clean, business_address_clean, country_clean FROM needed"),
    "dedupe_union": _with(_TOPK, "SELECT source1_entity_id AS entity_id FROM topk UNION SELECT candidate_entity_id FROM topk"),
    "label_join": _with(_LAB, "SELECT source1_entity_id, candidate_entity_id, label FROM labelled"),
    "label_counts": _with((*_WHOLE, TRUTH, LABELLED), "SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (2.0 * count(*)), 6) AS weight FROM labelled GROUP BY label"),
    "name_jaccard": _with(_WHOLE, f"SELECT source1_entity_id, candidate_entity_id, round({_jaccard('business_name_clean')}, 6) AS name_token_jaccard {_SIDES}"),
    "addr_jaccard": _with(_TOPK, f"SELECT source1_entity_id, candidate_entity_id, round({_jaccard('business_address_clean')}, 6) AS address_token_jaccard {_SIDES}"),
    "flag_features": _with(_TOPK, f"SELECT source1_entity_id, candidate_entity_id, CAST(a.country_clean = b.country_clean AS INT) AS country_match, CAST(abs(length(a.business_name_clean) - length(b.business_name_clean)) AS INT) AS name_length_diff, CAST(split_part(a.business_name_clean, ' ', 1) = split_part(b.business_name_clean, ' ', 1) AND a.business_name_clean <> '' AS INT) AS name_first_token_match {_SIDES}"),
    "seq_ratio": _with((*_TOPK, _LCS), "SELECT source1_entity_id, candidate_entity_id, round(CASE WHEN length(x) + length(y) = 0 THEN 1.0 ELSE 2.0 * len(t) / (length(x) + length(y)) END, 6) AS name_seq_ratio FROM sides JOIN lcs USING (x, y)"),
    "quick_ratio": _with((*_TOPK, _CHARS, _QUICK), f"SELECT source1_entity_id, candidate_entity_id, round(2.0 * coalesce(common, 0) / (length(a.business_name_clean) + length(b.business_name_clean)), 6) AS quick_ratio {_SIDES} LEFT JOIN least_counts USING (source1_entity_id, candidate_entity_id)"),
    "tfidf_idf": _with((*_TOPK, NEEDED, IDF), "SELECT gram, df, round(idf, 6) AS idf FROM idf"),
    "tfidf_cosine": _with((*_TOPK, NEEDED, IDF), "SELECT k.source1_entity_id, k.candidate_entity_id, round(coalesce(d.d, 0.0), 6) AS name_tfidf_cosine FROM topk k LEFT JOIN (SELECT k.source1_entity_id, k.candidate_entity_id, sum(x.u * y.u) AS d FROM topk k JOIN unit x ON x.entity_id = k.source1_entity_id JOIN unit y ON y.entity_id = k.candidate_entity_id AND y.gram = x.gram GROUP BY 1, 2) d USING (source1_entity_id, candidate_entity_id)"),
    "group_split": _with((RECORDS,), "SELECT entity_id, ('0x' || substr(md5(entity_id || ':42'), 1, 8))::BIGINT % 100 < 20 AS validation FROM records WHERE source = 1"),
    "macro_f05": _with(_LAB, f"SELECT round(avg({F_BETA}), 6) AS macro_f, count(*) AS n_entities FROM (SELECT source1_entity_id, count(*) FILTER (label = 1 AND blocking_score >= 0.5) AS tp, count(*) FILTER (blocking_score >= 0.5) AS n_pred, count(*) FILTER (label = 1) AS n_true FROM labelled GROUP BY 1)"),
    "threshold_sweep": _with((*_LAB, SWEEP), "SELECT * FROM swept"),
    "best_threshold": _with((*_LAB, SWEEP), "SELECT * FROM swept ORDER BY macro_f DESC, threshold LIMIT 1"),
    "match_lists": _with(_TOPK, "SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(k.candidate_entity_id, ',' ORDER BY k.blocking_score DESC, k.candidate_entity_id) FILTER (k.blocking_score >= 0.5), '') AS matched_entity_ids FROM entities e LEFT JOIN topk k ON k.source1_entity_id = e.entity_id WHERE e.source = 1 GROUP BY 1"),
    "dry_run_limit": _with((RECORDS,), "SELECT entity_id, source FROM records QUALIFY row_number() OVER (PARTITION BY source ORDER BY ord, entity_id) <= CASE WHEN source = 1 THEN 20 ELSE 200 END"),
}
_UNIT = "unit AS (SELECT entity_id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id)) AS u FROM (SELECT g.entity_id, g.gram, g.tf * i.idf AS w FROM grams g JOIN idf i USING (gram) WHERE g.entity_id IN (SELECT entity_id FROM needed)))"
SQL["tfidf_cosine"] = SQL["tfidf_cosine"].replace(IDF, f"{IDF}, {_UNIT}", 1)
SQL["tsv_round_trip"] = _with((RECORDS,), "SELECT entity_id, business_name, business_address, country FROM records")
