"""The registered queries as DuckDB SQL, over the same test tables.

The adapter views come first; each query lists the views it uses. The SQL is written from
the meaning of the operators and shares only the label constants with the Spark code.
"""

from __future__ import annotations

from annoloom import schema as S
from annoloom.functions.text import WHITESPACE


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"trim({expr}, {lit(WHITESPACE)})"


_TARGET = "CASE WHEN n_chars < 120 THEN '' ELSE '[sr] ' || text END"
_KIND = "CASE WHEN n_chars < 800 THEN 'query' ELSE 'passage' END"
_FLAGS = "unnest(['A', 'N', 'R'])"
_LABELS = "[" + ", ".join(lit(c) for c in S.ERROR_CATEGORIES) + "]"
_MARKERS = "(" + ", ".join(lit(m) for m in S.NO_CORRECTION_MARKERS) + ")"
_LEGACY = "(" + ", ".join(lit(m) for m in S.LEGACY_NO_CORRECTION_MARKERS) + ")"
_SCORES = " ".join(f"WHEN {i} THEN {lit(s)}" for i, s in enumerate(S.SCORE_LABELS, start=1))


def digit(expr: str) -> str:
    return f"try_cast(nullif(regexp_extract({strip(expr)}, '^[0-9]'), '') AS integer)"


def band(expr: str) -> str:
    return (f"CASE WHEN {expr} BETWEEN 1 AND 2 THEN 'low' WHEN {expr} = 3 THEN 'medium' "
            f"WHEN {expr} BETWEEN 4 AND 5 THEN 'high' END")


def accepted_legacy(expr: str) -> str:
    return f"lower({strip(f'coalesce({expr}, {lit(str())})')}) IN {_LEGACY}"


def uncorrected(text: str, target: str) -> str:
    t = strip(f"coalesce({text}, '')")
    return f"(lower({t}) IN {_MARKERS} OR {t} = {strip(f'coalesce({target}, {lit(str())})')})"


_ANSWERS = f"""
SELECT 'r' || event_id AS response_id, event_id, event_id AS seq, event_type,
       CAST(user_id AS varchar) AS user_id, ts AS updated_at, k,
       CASE event_type WHEN 'error' THEN 'discarded' WHEN 'view' THEN 'draft'
                       ELSE 'submitted' END AS status,
       CASE k % 7 WHEN 0 THEN NULL {_SCORES} ELSE 'n/a' END AS quality_score,
       CASE WHEN k % 10 = 9 THEN [{lit(S.NO_ERROR_LABEL)}]
            ELSE [{_LABELS}[1 + k % 9], {_LABELS}[1 + (k + 4) % 9]] END AS error_categories,
       CASE WHEN event_type = 'purchase' THEN 'checked' END AS comment
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS integer) AS k FROM events)"""

_CORRECTED = """CASE WHEN k % 4 = 0 THEN 'No corrections' WHEN k % 4 = 1 THEN target_text
                     WHEN k % 4 = 2 THEN '' ELSE target_text || ' ' || event_type END"""

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_records": ((), f"""
        SELECT 'rec_' || doc_id AS record_id, source AS benchmark, {_KIND} AS record_type,
               ({_KIND}) || '_' || doc_id AS task_id, text AS source_text,
               {_TARGET} AS target_text,
               CASE lang WHEN 'de' THEN 'pending' WHEN 'es' THEN 'discarded'
                         ELSE 'completed' END AS status
        FROM documents"""),
    "fx_benchmarks": ((), """
        SELECT benchmark, CAST(regexp_extract(benchmark, '[0-9]+') AS integer) AS position
        FROM (SELECT DISTINCT source AS benchmark FROM documents
              UNION ALL SELECT 'src999')"""),
    "fx_answers": ((), _ANSWERS),
    "fx_responses": (("fx_records", "fx_answers"), f"""
        SELECT a.* EXCLUDE (k, event_type, event_id), record_id, {_CORRECTED} AS corrected_text
        FROM (SELECT *, 'rec_' || (event_id // 10) AS record_id FROM fx_answers) a
        JOIN (SELECT record_id, target_text FROM fx_records) USING (record_id)"""),
    "fx_later": (("fx_records",), """
        SELECT * REPLACE (CASE WHEN status = 'pending' AND benchmark IN ('src0', 'src1') THEN 'completed'
                               ELSE status END AS status) FROM fx_records"""),
    "fx_done_later": (("fx_later", "fx_answered"), """
        SELECT p.* REPLACE ('submitted' AS status, CASE WHEN p.status = 'draft' THEN '5 – x' ELSE quality_score END
                            AS quality_score)
        FROM fx_answered p JOIN fx_later r ON r.record_id = p.record_id AND r.status IN ('completed', 'discarded')
        WHERE p.status IN ('submitted', 'draft')"""),
    "fx_answered": (("fx_answers",), """
        SELECT *, 'rec_' || (event_id // 10) AS record_id FROM fx_answers"""),
    "fx_cal": (("fx_answers",), """
        SELECT *, 'cal_' || (event_id // 50) AS record_id FROM fx_answers"""),
    "fx_users": ((), """
        SELECT CAST(user_id AS varchar) AS user_id,
               'ann_' || lpad(CAST(user_id AS varchar), 6, '0') AS username,
               CASE WHEN user_id = 0 THEN 'owner' ELSE 'annotator' END AS role
        FROM (SELECT DISTINCT user_id FROM events
              WHERE event_type = 'signup' AND value >= 100)"""),
    "fx_members": ((), """
        SELECT DISTINCT CAST(user_id AS varchar) AS user_id FROM events
        WHERE event_type = 'purchase' AND value >= 100"""),
    "fx_facts": (("fx_records", "fx_responses", "fx_users"), f"""
        SELECT *, coalesce(status = 'submitted' AND score <= 2
                  AND ({uncorrected('correction', 'target_text')}
                       OR list_contains(categories, {lit(S.NO_ERROR_LABEL)})), false) AS flagged
        FROM (SELECT response_id, p.record_id, coalesce(username, substr(p.user_id, 1, 8)) AS annotator,
                     benchmark, record_type, task_id, p.status,
                     CASE WHEN sub THEN {digit('quality_score')} END AS score,
                     CASE WHEN sub THEN coalesce(CAST({digit('quality_score')} AS varchar), '?')
                          ELSE '-' END AS score_text,
                     CASE WHEN sub THEN {strip("coalesce(nullif(quality_score, ''), '?')")}
                          ELSE 'Discarded' END AS score_label,
                     quality_score, source_text, target_text,
                     CASE WHEN sub THEN coalesce(corrected_text, '') ELSE '' END AS correction,
                     CASE WHEN sub THEN coalesce(comment, '') ELSE '' END AS comment,
                     CASE WHEN sub THEN error_categories ELSE [] END AS categories,
                     strftime(updated_at, '%Y-%m-%d %H:%M') AS date
              FROM (SELECT *, status = 'submitted' AS sub FROM fx_responses
                    WHERE status IN ('submitted', 'discarded')) p
              JOIN fx_records r ON r.record_id = p.record_id
                   AND r.status IN ('completed', 'discarded')
              LEFT JOIN fx_users u ON u.user_id = p.user_id)"""),
    "fx_done": (("fx_records", "fx_responses"), """
        SELECT p.* FROM fx_responses p JOIN fx_records r
             ON r.record_id = p.record_id AND r.status IN ('completed', 'discarded')
        WHERE p.status IN ('submitted', 'discarded')"""),
    "fx_completed": (("fx_records", "fx_responses", "fx_users"), """
        SELECT p.record_id AS id, response_id, benchmark, record_type, task_id,
               source_text AS source_text_en, target_text AS translated_text_sr,
               quality_score, error_categories, corrected_text AS corrected_text_sr, comment,
               coalesce(username, substr(p.user_id, 1, 8)) AS annotator
        FROM fx_responses p JOIN fx_records r ON r.record_id = p.record_id
        LEFT JOIN fx_users u ON u.user_id = p.user_id
        WHERE p.status = 'submitted' AND r.status = 'completed'"""),
    "fx_turns": ((), """
        SELECT 'turn_' || conv_id || '_' || turn AS record_id, conv_id, turn, role, text,
               CASE WHEN role <> 'system' THEN 'task_turn_' || conv_id || '_' || turn END AS task_id
        FROM conversations"""),
    "fx_turn_responses": (("fx_turns",), """
        SELECT 'r_' || t.record_id AS response_id, t.record_id, CAST(t.conv_id AS varchar) AS user_id,
               CASE WHEN t.role = 'system' THEN 'draft' ELSE 'submitted' END AS status,
               CASE WHEN t.turn < 6 THEN CAST(t.turn % 5 + 1 AS varchar) END AS quality_score,
               CASE (t.conv_id + t.turn) % 5 WHEN 0 THEN 'Bez ispravki' WHEN 1 THEN ''
                    WHEN 2 THEN t.text WHEN 3 THEN replace(t.text, 'en', 'é')
                    ELSE coalesce(n.text, t.text) END AS corrected_text,
               t.text AS target_text, t.task_id
        FROM fx_turns t LEFT JOIN conversations n
             ON n.conv_id = t.conv_id AND n.turn = t.turn + 1"""),
    "fx_targets": ((), f"""
        SELECT {_FLAGS} AS benchmark, 'queries' AS config, CAST(o_orderkey AS varchar) AS id,
               'order ' || o_orderpriority AS text FROM orders
        UNION ALL
        SELECT {_FLAGS}, 'corpus', 'p' || p_partkey,
               CASE WHEN p_size = 1 THEN '' ELSE p_name END FROM part
        UNION ALL
        SELECT {_FLAGS}, 'corpus', 'c' || c_custkey, c_name FROM customer"""),
    "fx_sources": ((), f"""
        SELECT {_FLAGS} AS benchmark, 'queries' AS config, CAST(o_orderkey AS varchar) AS id,
               CAST(NULL AS varchar) AS title, ' ' || chr(10) || o_orderstatus || chr(9) AS text,
               CAST(0 AS bigint) AS seq
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT {_FLAGS}, 'corpus', 'p' || p_partkey,
               CASE WHEN p_size < 13 THEN '' ELSE p_brand END, p_name, 1
        FROM part WHERE p_brand <> 'Brand#13'
        UNION ALL
        SELECT {_FLAGS}, 'corpus', 'p' || p_partkey,
               CASE WHEN p_size < 13 THEN '' ELSE p_brand END,
               CASE WHEN p_retailprice < 950 THEN '' ELSE p_type END, 2
        FROM part WHERE p_brand <> 'Brand#13'"""),
    "fx_sources_last": (("fx_sources",), f"""
        SELECT benchmark, config, id, coalesce(title, '') AS title, coalesce(text, '') AS text,
               CASE WHEN {strip("coalesce(title, '')")} <> ''
                    THEN {strip("coalesce(title, '')")} || chr(10) || chr(10) || {strip('text')}
                    ELSE {strip('text')} END AS source_text
        FROM fx_sources
        QUALIFY row_number() OVER (PARTITION BY benchmark, config, id ORDER BY seq DESC) = 1"""),
    "fx_capped": ((), """
        SELECT l_returnflag AS benchmark, CAST(l_orderkey AS varchar) AS query_id,
               'p' || l_partkey AS corpus_id,
               row_number() OVER (PARTITION BY l_returnflag, l_orderkey
                                  ORDER BY l_linenumber, l_partkey, l_suppkey) AS position
        FROM lineitem"""),
    "fx_needed": (("fx_capped",), """
        SELECT DISTINCT benchmark, 'corpus' AS config, corpus_id AS id FROM fx_capped"""),
    "fx_ratings": (("fx_cal", "fx_users"), f"""
        SELECT record_id, annotator, score, error_categories AS cats,
               count(*) OVER (PARTITION BY record_id) AS raters
        FROM (SELECT c.*, {digit('quality_score')} AS score,
                     coalesce(username, substr(c.user_id, 1, 8)) AS annotator
              FROM fx_cal c LEFT JOIN fx_users u ON u.user_id = c.user_id
              WHERE c.status = 'submitted'
              QUALIFY row_number() OVER (PARTITION BY record_id, annotator
                                         ORDER BY seq DESC) = 1)"""),
    "fx_pairs": (("fx_ratings",), """
        SELECT a.annotator AS annotator_a, b.annotator AS annotator_b, a.record_id,
               a.score AS sa, b.score AS sb, a.cats AS ca, b.cats AS cb
        FROM fx_ratings a JOIN fx_ratings b
             ON a.record_id = b.record_id AND a.annotator < b.annotator"""),
    "fx_asked": (("fx_users", "fx_members"), """
        SELECT username FROM fx_users SEMI JOIN fx_members USING (user_id) WHERE role <> 'owner'"""),
    "fx_hashes": (("fx_records",), """
        SELECT record_id, benchmark, md5(source_text) AS source_key, md5(target_text) AS target_key,
               md5(source_text || chr(0) || target_text) AS pair_key,
               replace(substr(source_text, 1, 80), chr(10), ' ') AS preview
        FROM fx_records"""),
    "fx_targets_reopen": (("fx_facts", "fx_records"), """
        SELECT record_id, annotator FROM fx_facts WHERE flagged
        UNION ALL SELECT record_id, NULL FROM fx_records WHERE status = 'discarded'"""),
    "fx_named": (("fx_responses", "fx_users"), """
        SELECT p.*, coalesce(username, substr(p.user_id, 1, 8)) AS annotator
        FROM fx_responses p LEFT JOIN fx_users u ON u.user_id = p.user_id"""),
    "fx_passages": ((), f"""
        SELECT 'passage_' || query_id || '_' || idx AS id,
               s[1 + CASE WHEN idx < len(s) THEN idx ELSE 0 END] AS source_text,
               t[1 + CASE WHEN idx < len(t) THEN idx ELSE 0 END] AS target_text
        FROM (SELECT *, CASE WHEN sel < len(t) THEN sel ELSE 0 END AS idx
              FROM (SELECT *, greatest(coalesce(list_position(
                           list_transform(s, lambda x: length(x) > 300), true), 0) - 1, 0) AS sel
                    FROM (SELECT doc_id AS query_id, string_split(text, chr(10)) AS s,
                                 list_filter(list_transform(string_split(text, chr(10)),
                                     lambda x: translate(x, 'aeiou', 'eioua')),
                                     lambda x: length(x) > 40) AS t
                          FROM documents))
              WHERE len(s) > 0 AND len(t) > 0)
        WHERE {strip('source_text')} <> '' AND {strip('target_text')} <> ''"""),
}


def _needed_views(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed_views(VIEWS[name][0], seen)
            seen.append(name)
    return seen


def with_views(*names: str) -> str:
    order = _needed_views(names, [])
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order) + "\n" if order else ""


ORACLE: dict[str, str] = {}


def oracle(key: str, sql: str, *views: str) -> None:
    ORACLE[key] = with_views(*views) + sql


# ---- sources and sinks ----

oracle("ingest_jsonl", """
SELECT CAST(doc_id AS varchar) AS id, text AS source_text,
       CASE WHEN lang <> 'fr' THEN reverse(text) END AS target_text,
       CASE WHEN lang <> 'fr' THEN source END AS extra_source
FROM documents WHERE lang NOT IN ('es', 'de')""")

oracle("ingest_rejects", """
SELECT CASE lang WHEN 'de' THEN 'invalid JSON' ELSE 'missing required fields' END AS reason,
       count(*) AS lines, count(*) AS places
FROM documents WHERE lang IN ('es', 'de') GROUP BY 1""")

oracle("ingest_csv", """
SELECT CAST(doc_id AS varchar) AS id, text AS source_text, reverse(text) AS target_text,
       source AS origin FROM documents""")

_LOOKUP = """
SELECT benchmark, config, id, title, text FROM fx_sources_last
SEMI JOIN fx_needed USING (benchmark, config, id)"""
oracle("corpus_lookup", _LOOKUP, "fx_sources_last", "fx_needed")
oracle("materialised_lookup", _LOOKUP, "fx_sources_last", "fx_needed")

oracle("lookup_after_failure", _LOOKUP, "fx_sources_last", "fx_needed")
oracle("indexed_lookup", _LOOKUP, "fx_sources_last", "fx_needed")

oracle("lookup_coverage", """
SELECT benchmark, config, count(*) AS needed, count(hit) AS found,
       count(*) - count(hit) AS missing
FROM fx_needed LEFT JOIN (SELECT benchmark, config, id, 1 AS hit FROM fx_sources_last)
     USING (benchmark, config, id)
GROUP BY ALL""", "fx_sources_last", "fx_needed")

oracle("missing_ids", """
SELECT benchmark, config, id FROM fx_needed
ANTI JOIN fx_sources_last USING (benchmark, config, id)""", "fx_sources_last", "fx_needed")

oracle("upsert_records", """
SELECT record_id, CASE WHEN status = 'discarded' THEN 'rerun' ELSE benchmark END AS benchmark,
       record_type, task_id, source_text, target_text,
       CASE WHEN status = 'discarded' THEN 'pending' ELSE status END AS status
FROM fx_records
UNION ALL
SELECT 'new_' || record_id, benchmark, record_type, task_id, source_text, target_text, status
FROM fx_records WHERE status = 'pending'""", "fx_records")

ORACLE["upsert_bucketed"] = ORACLE["upsert_records"]

oracle("snapshot_records", """
SELECT record_id, CASE WHEN status = 'discarded' THEN 'Unknown' ELSE benchmark END AS benchmark,
       CASE WHEN status = 'discarded' THEN 'unknown' ELSE record_type END AS record_type,
       CASE WHEN status = 'discarded' THEN '' ELSE task_id END AS task_id, source_text, target_text, status
FROM fx_records""", "fx_records")

oracle("snapshot_responses", """
SELECT response_id, record_id, user_id, status, quality_score,
       array_to_string(error_categories, '|') AS error_categories, corrected_text
FROM fx_responses""", "fx_responses")

oracle("category_values", """
SELECT response_id, unnest(error_categories) AS category FROM fx_responses""", "fx_responses")

oracle("read_texts", """
SELECT 'b' AS benchmark, 'corpus' AS config, CAST(doc_id AS varchar) AS id, source AS title,
       CASE WHEN n_chars < 800 THEN reverse(text) ELSE text END AS text
FROM documents""")

oracle("read_relevance", """
SELECT benchmark || ':' || query_id AS query_id, string_agg(corpus_id, '|' ORDER BY position) AS positive_ids
FROM fx_capped GROUP BY ALL""", "fx_capped")

oracle("round_trip", "SELECT * EXCLUDE (task_id) FROM fx_records", "fx_records")

oracle("one_benchmark", """
SELECT record_id, benchmark, source_text FROM fx_records
WHERE benchmark = (SELECT min(benchmark) FROM fx_benchmarks)""", "fx_records", "fx_benchmarks")

# ---- facts ----

oracle("annotation_newest_first", """
SELECT response_id, record_id, annotator, date,
       row_number() OVER (ORDER BY date DESC, record_id, annotator, response_id) AS position
FROM fx_facts""", "fx_facts")

oracle("annotation_facts", """
SELECT * REPLACE (array_to_string(categories, '|') AS categories) FROM fx_facts""", "fx_facts")

oracle("annotation_search", """
SELECT response_id, record_id, annotator, benchmark, score_text FROM fx_facts
WHERE record_type = 'passage' AND flagged
  AND (contains(lower(source_text), 'grešaka') OR contains(lower(target_text), 'grešaka')
       OR contains(lower(correction), 'grešaka') OR contains(lower(comment), 'grešaka')
       OR contains(lower(annotator), 'grešaka') OR contains(lower(benchmark), 'grešaka')
       OR contains(lower(array_to_string(categories, ' ')), 'grešaka'))""", "fx_facts")

ORACLE["indexed_search"] = ORACLE["annotation_search"]

oracle("report_page", """
SELECT page, position, response_id, record_id, annotator, date, md5(source_text) AS text_key
FROM (SELECT *, row_number() OVER (ORDER BY date DESC, record_id, annotator, response_id) AS position,
             (count(*) OVER () + 19) // 20 AS last
      FROM fx_facts),
     (SELECT unnest(generate_series(1, (SELECT (count(*) + 19) // 20 FROM fx_facts))) AS page)
WHERE page IN (1, (last + 1) // 2, last) AND (position - 1) // 20 + 1 = page""", "fx_facts")

oracle("annotation_sorted", """
SELECT response_id, record_id, annotator, score_text, date,
       row_number() OVER (ORDER BY coalesce(nullif(score, 0), 99), record_id, annotator,
                          response_id) AS position
FROM fx_facts""", "fx_facts")

oracle("filter_choices", """
SELECT DISTINCT 'annotator' AS facet, annotator AS value FROM fx_facts
UNION ALL SELECT DISTINCT 'benchmark', benchmark FROM fx_facts""", "fx_facts")

oracle("resolve_annotators",
       "SELECT response_id, user_id, annotator FROM fx_named", "fx_named")

oracle("latest_response", """
SELECT record_id, user_id, max_by(response_id, seq) AS response_id, max_by(status, seq) AS status
FROM fx_cal GROUP BY ALL""", "fx_cal")

# ---- scalars ----

oracle("format_source", f"""
SELECT benchmark, config, id, seq,
       CASE WHEN {strip("coalesce(title, '')")} <> ''
            THEN {strip('title')} || chr(10) || chr(10) || {strip("coalesce(text, '')")}
            ELSE {strip("coalesce(text, '')")} END AS source_text
FROM fx_sources""", "fx_sources")

oracle("score_parse", f"""
SELECT response_id, {digit('quality_score')} AS score,
       coalesce(CAST({digit('quality_score')} AS varchar), '?') AS score_text
FROM fx_responses""", "fx_responses")

oracle("score_band", f"""
SELECT response_id, {band('s')} AS band, coalesce({band('s')}, nullif(quality_score, '')) AS label
FROM (SELECT *, {digit('quality_score')} AS s FROM fx_responses)""", "fx_responses")

oracle("no_correction", f"""
SELECT response_id, {uncorrected('corrected_text', 'target_text')} AS uncorrected,
       {accepted_legacy('corrected_text')} AS accepted_legacy
FROM fx_responses JOIN fx_records USING (record_id)""", "fx_responses", "fx_records")

oracle("flagged", "SELECT response_id, record_id, annotator FROM fx_facts WHERE flagged",
       "fx_facts")

# DuckDB's levenshtein counts bytes. Giving every non-ASCII letter of the texts its own
# unused control character makes a byte of each character without changing any distance.
_LETTERS = "éèêëçäöüßñíóáúàÉÈÊÇÄÖÜÑÍÓÁÚÀ"
_BYTES = "".join(chr(b) for b in range(1, 32) if b not in (9, 10, 13))


def one_byte(expr: str) -> str:
    return f"translate({expr}, {lit(_LETTERS)}, {lit(_BYTES[:len(_LETTERS)])})"


_DISTANCE = f"levenshtein({one_byte('target_text')}, {one_byte('corrected_text')})"

oracle("edit_distance", f"""
SELECT response_id, CAST({_DISTANCE} AS integer) AS distance FROM fx_turn_responses""",
       "fx_turn_responses")

oracle("unwrap_value", """
SELECT event_id, CASE event_type WHEN 'view' THEN k || ' é' WHEN 'signup' THEN NULL
                                 ELSE k END AS value
FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""")

oracle("content_hash", """
SELECT record_id, source_key AS source_hash, target_key AS target_hash, pair_key AS pair_hash
FROM fx_hashes""", "fx_hashes")

# ---- export ----

_EXPORT = ("SELECT * REPLACE (array_to_string(error_categories, '|') AS error_categories) "
           "FROM fx_completed")
_SCORED = f"coalesce({digit('quality_score')} >= 3, false)"
_FIXED = f"NOT {uncorrected('corrected_text_sr', 'translated_text_sr')}"
oracle("export_current", _EXPORT, "fx_completed")
oracle("export_min_score", f"{_EXPORT} WHERE {_SCORED}", "fx_completed")
oracle("export_require_correction", f"{_EXPORT} WHERE {_SCORED} AND {_FIXED}", "fx_completed")
oracle("export_filter_counts", f"""
SELECT count(*) AS before, count(*) FILTER ({_SCORED} AND {_FIXED}) AS after,
       count(*) - count(*) FILTER ({_SCORED} AND {_FIXED}) AS removed
FROM fx_completed""", "fx_completed")

oracle("export_legacy", f"""
SELECT coalesce(task_id, record_id) AS id,
       CASE WHEN m THEN corrected_text ELSE 'Bez ispravki' END AS corrected_text_sr,
       quality_score, coalesce(username, p.user_id) AS annotator_id,
       '2024-02-01T00:00:00Z' AS timestamp, m AS was_modified,
       CAST(CASE WHEN m THEN {_DISTANCE} ELSE 0 END AS integer) AS edit_distance
FROM (SELECT *, NOT {accepted_legacy('corrected_text')} AS m FROM fx_turn_responses) p
LEFT JOIN fx_users u ON u.user_id = p.user_id
WHERE status = 'submitted' AND quality_score IS NOT NULL""", "fx_turn_responses", "fx_users")

# ---- assembly ----


def candidates(cap: int) -> str:
    return f"""
(SELECT w.benchmark, CASE w.config WHEN 'queries' THEN 'query' ELSE 'passage' END AS record_type,
        w.id, coalesce(s.source_text, '') AS source_text, coalesce(t.text, '') AS target_text
 FROM (SELECT benchmark, config, id FROM fx_targets WHERE config = 'queries'
       UNION ALL SELECT DISTINCT benchmark, 'corpus', corpus_id FROM fx_capped
                 WHERE position <= {cap}) w
 LEFT JOIN fx_targets t ON t.benchmark = w.benchmark AND t.config = w.config AND t.id = w.id
 LEFT JOIN fx_sources_last s
      ON s.benchmark = w.benchmark AND s.config = w.config AND s.id = w.id)"""


_RETRIEVAL = ("fx_targets", "fx_sources_last", "fx_capped")
oracle("assemble_pairs", f"""
SELECT benchmark || '_' || record_type || '_' || id AS record_id, benchmark, record_type,
       record_type || '_' || id AS task_id, source_text, target_text,
       target_text AS suggested_text, 'pending' AS status
FROM {candidates(3)} WHERE source_text <> '' AND target_text <> ''""", *_RETRIEVAL)

oracle("pair_skips", f"""
SELECT benchmark, record_type, count(*) AS wanted,
       count(*) FILTER (source_text <> '' AND target_text <> '') AS built,
       count(*) FILTER (NOT (source_text <> '' AND target_text <> '')) AS skipped
FROM {candidates(3)} GROUP BY ALL""", *_RETRIEVAL)

oracle("build_counts", f"""
SELECT coalesce(benchmark, 'TOTAL') AS benchmark,
       count(*) FILTER (record_type = 'query') AS queries,
       count(*) FILTER (record_type = 'passage') AS passages, count(*) AS total
FROM {candidates(10)} WHERE source_text <> '' AND target_text <> ''
GROUP BY ROLLUP (benchmark)""", *_RETRIEVAL)

oracle("relevance_stats", """
SELECT l_returnflag AS benchmark, count(*) AS pairs, count(DISTINCT l_orderkey) AS queries
FROM lineitem GROUP BY 1""")

oracle("relevance_lists", """
SELECT benchmark, query_id, string_agg(corpus_id, '|' ORDER BY position) AS positive_ids
FROM fx_capped GROUP BY ALL""", "fx_capped")

oracle("relevance_chunks", """
SELECT benchmark, query_id, (position - 1) // 3 AS chunk, (position - 1) // 3 * 3 + 1 AS first,
       string_agg(corpus_id, '|' ORDER BY position) AS corpus_ids
FROM fx_capped GROUP BY ALL""", "fx_capped")

oracle("capped_lists", """
SELECT benchmark, query_id, string_agg(corpus_id, '|' ORDER BY position) AS positive_ids
FROM fx_capped WHERE position <= 3 GROUP BY ALL""", "fx_capped")

oracle("relevance_flat", """
SELECT benchmark, query_id, corpus_id, position - 1 AS seq FROM fx_capped""", "fx_capped")

oracle("cap_positives", """
SELECT benchmark, query_id, corpus_id, CAST(position AS integer) AS position FROM fx_capped
WHERE position <= 3""", "fx_capped")

oracle("needed_passages", """
SELECT DISTINCT benchmark, corpus_id AS id FROM fx_capped WHERE position <= 3""", "fx_capped")

oracle("query_pairs", """
SELECT 'query_' || o_custkey AS id, o_orderstatus || ' ' || o_orderkey AS source_text,
       target_text
FROM orders JOIN (
  SELECT o_custkey, max_by(o_orderpriority || ' ' || CAST(CAST(o_orderdate AS date) AS varchar),
                           o_orderkey) AS target_text
  FROM orders GROUP BY 1) USING (o_custkey)""")

oracle("passage_pairs", "SELECT * FROM fx_passages", "fx_passages")
oracle("passage_pairs_list_layout", "SELECT * FROM fx_passages", "fx_passages")

# ---- progress ----

_COUNTS = """
(SELECT benchmark, position,
        count(*) FILTER (record_type = 'query' AND status <> 'pending') AS queries_done,
        count(*) FILTER (record_type = 'query') AS queries_total,
        count(*) FILTER (record_type = 'passage' AND status <> 'pending') AS passages_done,
        count(*) FILTER (record_type = 'passage') AS passages_total
 FROM fx_benchmarks LEFT JOIN fx_records USING (benchmark) GROUP BY ALL)"""

_PROGRESS = f"""
SELECT CASE WHEN tot THEN 'TOTAL' ELSE benchmark END AS benchmark,
       CASE WHEN NOT tot THEN position END AS position,
       queries_done, queries_total, queries_done * 100 // nullif(queries_total, 0) AS queries_pct,
       passages_done, passages_total,
       passages_done * 100 // nullif(passages_total, 0) AS passages_pct,
       queries_done + passages_done AS done, queries_total + passages_total AS total,
       (queries_done + passages_done) * 100 // nullif(queries_total + passages_total, 0) AS pct
FROM (SELECT false AS tot, * FROM {_COUNTS}
      UNION ALL
      SELECT true, NULL, NULL, CAST(sum(queries_done) AS bigint), CAST(sum(queries_total) AS bigint),
             CAST(sum(passages_done) AS bigint), CAST(sum(passages_total) AS bigint)
      FROM {_COUNTS})"""
oracle("benchmark_progress", _PROGRESS, "fx_benchmarks", "fx_records")
oracle("progress_after_changes", _PROGRESS.replace("fx_records", "fx_later"), "fx_benchmarks", "fx_later")

oracle("report_benchmark_progress", f"""
SELECT *, queries_done + passages_done AS done, queries_total + passages_total AS total,
       CASE WHEN queries_total + passages_total > 0 THEN CAST(round((queries_done + passages_done)
            * 100 / (queries_total + passages_total)) AS bigint) ELSE 0 END AS pct
FROM {_COUNTS}""", "fx_benchmarks", "fx_records")

_SCORE_COUNTS = ",\n".join(f"count(*) FILTER (score = {i}) AS s{i}" for i in range(1, 6))

_ANNOTATORS = f"""
SELECT annotator, count(*) FILTER (score IS NOT NULL OR status = 'discarded') AS total,
       {_SCORE_COUNTS}, count(*) FILTER (status = 'discarded') AS skipped,
       count(*) FILTER (status = 'submitted' AND score IS NULL) AS unrated,
       count(*) FILTER (status = 'submitted') AS submitted
FROM (SELECT p.status, coalesce(username, substr(p.user_id, 1, 8)) AS annotator,
             CASE WHEN p.status = 'submitted' THEN {digit('quality_score')} END AS score
      FROM fx_done p LEFT JOIN fx_users u ON u.user_id = p.user_id
      WHERE p.status = 'discarded' OR quality_score IS NOT NULL)
GROUP BY 1"""
oracle("annotator_progress", _ANNOTATORS, "fx_done", "fx_users")
oracle("annotators_after_changes", _ANNOTATORS.replace("fx_done", "fx_done_later"), "fx_done_later", "fx_users")

oracle("annotator_report", f"""
SELECT annotator, count(*) AS total, {_SCORE_COUNTS},
       round(avg(score) FILTER (score BETWEEN 1 AND 5), 6) AS avg_score,
       count(*) FILTER (status = 'discarded') AS discarded,
       count(*) FILTER (flagged) AS flagged,
       row_number() OVER (ORDER BY count(*) DESC, annotator) AS rank
FROM fx_facts GROUP BY 1""", "fx_facts")

oracle("category_frequency", f"""
SELECT category, count(*) AS uses, any_value(n) AS submissions,
       count(*) * 100 // any_value(n) AS pct
FROM (SELECT unnest(error_categories) AS category FROM fx_done WHERE status = 'submitted'),
     (SELECT count(*) AS n FROM fx_done
      WHERE status = 'submitted' AND {digit('quality_score')} IS NOT NULL)
GROUP BY 1""", "fx_done")

oracle("category_by_annotator", """
SELECT annotator, category, count(*) AS uses
FROM (SELECT annotator, unnest(categories) AS category FROM fx_facts) GROUP BY ALL""", "fx_facts")

oracle("report_summary", """
SELECT total_records, total_done, CAST(round(total_done * 100 / total_records) AS bigint) AS done_pct,
       annotators, submissions, avg_score, flags
FROM (SELECT count(*) AS total_records, count(*) FILTER (status <> 'pending') AS total_done
      FROM fx_records SEMI JOIN fx_benchmarks USING (benchmark)),
     (SELECT count(DISTINCT annotator) AS annotators,
             count(*) FILTER (score BETWEEN 1 AND 5) AS submissions,
             round(avg(score), 6) AS avg_score, count(*) FILTER (flagged) AS flags
      FROM fx_facts)""", "fx_records", "fx_benchmarks", "fx_facts")

def _measures(section: str, name: str, source: str, *measures: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{section}' AS section, {name} AS name, '{m}' AS detail, round(CAST({m} AS double), 6) AS value FROM {source}"
        for m in measures)


def _plain(key: str, *views: str) -> str:
    """The SQL of a query without its views."""
    return ORACLE[key].removeprefix(with_views(*views))


oracle("report_bundle", f"""
, summary AS ({_plain('report_summary', 'fx_records', 'fx_benchmarks', 'fx_facts')}),
marks AS ({_plain('report_benchmark_progress', 'fx_benchmarks', 'fx_records')}),
people AS ({_plain('annotator_report', 'fx_facts')})
{_measures('summary', "''", 'summary', 'total_records', 'total_done', 'done_pct', 'annotators', 'submissions', 'avg_score', 'flags')}
UNION ALL {_measures('benchmarks', 'benchmark', 'marks', 'done', 'total', 'pct')}
UNION ALL {_measures('annotators', 'annotator', 'people', 'total', 's1', 's2', 's3', 's4', 's5', 'avg_score', 'discarded', 'flagged')}
UNION ALL SELECT 'categories', annotator, category, CAST(uses AS double) FROM ({_plain('category_by_annotator', 'fx_facts')})
UNION ALL SELECT 'choices', facet, value, 1.0 FROM ({_plain('filter_choices', 'fx_facts')})
UNION ALL SELECT 'annotations', response_id, md5(source_text || correction), 1.0 FROM fx_facts""",
       "fx_records", "fx_benchmarks", "fx_facts")

oracle("access_roster", """
SELECT username, role, user_id IN (SELECT user_id FROM fx_members) AS in_workspace
FROM fx_users WHERE role <> 'owner'""", "fx_users", "fx_members")

# ---- first-generation statistics ----

oracle("legacy_completion", """
SELECT count(*) AS total_records, count(hit) AS completed_records,
       round(count(hit) * 100.0 / count(*), 6) AS completion_pct
FROM fx_records LEFT JOIN (SELECT DISTINCT record_id, 1 AS hit FROM fx_responses
                           WHERE status = 'submitted') USING (record_id)""",
       "fx_records", "fx_responses")

_LEGACY_ROWS = f"""
(SELECT p.*, coalesce(username, p.user_id) AS annotator,
        coalesce({band(digit('quality_score'))}, nullif(quality_score, '')) AS label,
        NOT {accepted_legacy('corrected_text')} AS modified
 FROM fx_responses p LEFT JOIN fx_users u ON u.user_id = p.user_id
 WHERE p.status = 'submitted')"""
_RU = ("fx_responses", "fx_users")

oracle("tasks_per_annotator", f"""
SELECT annotator, count(*) AS tasks FROM {_LEGACY_ROWS} GROUP BY 1""", *_RU)

oracle("score_distribution", f"""
SELECT l AS label, count(*) FILTER (label = l) AS n,
       round(count(*) FILTER (label = l) * 100.0 / nullif(count(label), 0), 6) AS pct
FROM (SELECT unnest(['high', 'medium', 'low']) AS l), {_LEGACY_ROWS} GROUP BY 1""", *_RU)

oracle("modification_rate", f"""
SELECT count(*) FILTER (modified) AS modified, count(*) FILTER (NOT modified) AS accepted,
       round(count(*) FILTER (modified) * 100.0 / count(*), 6) AS modified_pct,
       round(100.0 - count(*) FILTER (modified) * 100.0 / count(*), 6) AS accepted_pct
FROM {_LEGACY_ROWS}""", *_RU)

_BANDS = ", ".join(f"count(*) FILTER (label = '{b}') AS {b}" for b in S.QUALITY_BANDS)

oracle("score_by_annotator", f"""
SELECT annotator, count(*) AS total, {_BANDS} FROM {_LEGACY_ROWS}
WHERE label IS NOT NULL GROUP BY 1""", *_RU)

oracle("dashboard_stats", f"""
SELECT total_records, completed_records, total_annotations, modified, accepted,
       round(completed_records / total_records * 100, 6) AS completion_pct,
       round(modified / greatest(total_annotations, 1) * 100, 6) AS modification_pct
FROM (SELECT count(*) AS total_records FROM fx_records),
     (SELECT count(DISTINCT task_id) AS completed_records, count(*) AS total_annotations,
             count(*) FILTER (modified) AS modified, count(*) FILTER (NOT modified) AS accepted
      FROM {_LEGACY_ROWS} JOIN fx_records USING (record_id))""", *_RU, "fx_records")

oracle("dashboard_per_annotator", f"""
SELECT annotator, count(*) AS annotations, {_BANDS}, count(*) FILTER (modified) AS modified,
       count(*) FILTER (NOT modified) AS accepted
FROM {_LEGACY_ROWS} GROUP BY 1""", *_RU)

oracle("sample_annotations", f"""
SELECT task_id AS record_id, response_id, annotator, quality_score,
       {strip("coalesce(corrected_text, '')")} AS corrected_text, modified AS was_modified,
       substr(source_text, 1, 100) AS source_text, substr(target_text, 1, 100) AS target_text
FROM {_LEGACY_ROWS} JOIN fx_records r USING (record_id)
ORDER BY r.record_id, response_id LIMIT 20""", *_RU, "fx_records")

# ---- agreement ----


def kappa(a: str, b: str, k: int, source: str, keys: str) -> str:
    """Kappa from the full k x k matrix of observed and expected counts."""
    w = (k - 1) ** 2
    cells = f"""
(SELECT {keys}, i, j, 1.0 - (i - j) * (i - j) / {w} AS weight
 FROM (SELECT DISTINCT {keys} FROM {source}), range(1, {k + 1}) r(i), range(1, {k + 1}) c(j))"""
    return f"""
(SELECT {keys}, any_value(n) AS n, sum(weight * coalesce(observed, 0)) AS num,
        sum(weight * coalesce(row_n, 0) * coalesce(col_n, 0)) / any_value(n) AS den
 FROM {cells}
 LEFT JOIN (SELECT {keys}, count(*) AS n FROM {source} GROUP BY ALL) USING ({keys})
 LEFT JOIN (SELECT {keys}, {a} AS i, {b} AS j, count(*) AS observed FROM {source}
            WHERE {a} BETWEEN 1 AND {k} AND {b} BETWEEN 1 AND {k} GROUP BY ALL)
      USING ({keys}, i, j)
 LEFT JOIN (SELECT {keys}, {a} AS i, count(*) AS row_n FROM {source}
            WHERE {a} BETWEEN 1 AND {k} AND {b} BETWEEN 1 AND {k} GROUP BY ALL) USING ({keys}, i)
 LEFT JOIN (SELECT {keys}, {b} AS j, count(*) AS col_n FROM {source}
            WHERE {a} BETWEEN 1 AND {k} AND {b} BETWEEN 1 AND {k} GROUP BY ALL) USING ({keys}, j)
 GROUP BY {keys})"""


_KAPPA_COLUMNS = """
CASE WHEN abs(den) < 1e-9 THEN 1.0 WHEN abs(n - den) < 1e-9 THEN NULL
     ELSE round(1.0 - (n - num) / (n - den), 6) END AS kappa,
CASE WHEN abs(den) < 1e-9 THEN 'zero_expected' WHEN abs(n - den) < 1e-9 THEN 'constant_raters'
     ELSE 'ok' END AS kappa_status"""
_BAND = """
CASE WHEN kappa < 0.2 THEN 'Poor' WHEN kappa < 0.4 THEN 'Fair' WHEN kappa < 0.6 THEN 'Moderate'
     WHEN kappa < 0.8 THEN 'Substantial' WHEN kappa IS NOT NULL THEN 'Almost perfect' END AS band"""
_BOTH = "(SELECT * FROM fx_pairs WHERE sa IS NOT NULL AND sb IS NOT NULL)"

oracle("pairwise_agreement", f"""
SELECT annotator_a, annotator_b, shared, kappa, kappa_status, {_BAND}, exact_pct, mean_diff
FROM (SELECT annotator_a, annotator_b, {_KAPPA_COLUMNS}
      FROM {kappa('sa', 'sb', 5, _BOTH, 'annotator_a, annotator_b')})
JOIN (SELECT annotator_a, annotator_b, count(*) AS shared,
             round(100.0 * count(*) FILTER (sa = sb) / count(*), 6) AS exact_pct,
             round(avg(abs(sa - sb)), 6) AS mean_diff
      FROM {_BOTH} GROUP BY ALL) USING (annotator_a, annotator_b)""", "fx_pairs")

oracle("pairs_without_overlap", f"""
SELECT a.annotator AS annotator_a, b.annotator AS annotator_b
FROM (SELECT DISTINCT annotator FROM fx_ratings WHERE raters >= 2) a
JOIN (SELECT DISTINCT annotator FROM fx_ratings WHERE raters >= 2) b ON a.annotator < b.annotator
     AND (a.annotator IN (FROM fx_asked) OR b.annotator IN (FROM fx_asked))
ANTI JOIN {_BOTH} o ON o.annotator_a = a.annotator AND o.annotator_b = b.annotator""",
       "fx_ratings", "fx_pairs", "fx_asked")

oracle("overlap_counts", f"""
SELECT annotator, count(peer) AS with_overlap, any_value(n) - 1 - count(peer) AS without_overlap
FROM (SELECT DISTINCT annotator FROM fx_ratings WHERE raters >= 2)
LEFT JOIN (SELECT annotator_a AS annotator, annotator_b AS peer FROM {_BOTH}
           UNION SELECT annotator_b, annotator_a FROM {_BOTH}) USING (annotator),
     (SELECT count(DISTINCT annotator) AS n FROM fx_ratings WHERE raters >= 2)
GROUP BY 1""", "fx_ratings", "fx_pairs")

oracle("calibration_distribution", f"""
SELECT annotator, count(*) AS n, {_SCORE_COUNTS}, round(avg(score), 6) AS avg_score
FROM fx_ratings WHERE raters >= 2 AND score IS NOT NULL GROUP BY 1""", "fx_ratings")

oracle("category_agreement", """
SELECT annotator_a, annotator_b, category, count(*) AS shared,
       count(*) FILTER (list_contains(ca, category) = list_contains(cb, category)) AS agreed,
       round(100.0 * count(*) FILTER (list_contains(ca, category) = list_contains(cb, category))
             / count(*), 6) AS agreement_pct
FROM fx_pairs, (SELECT DISTINCT unnest(cats) AS category FROM fx_ratings WHERE raters >= 2)
GROUP BY ALL""", "fx_ratings", "fx_pairs")

_RATED = ("(SELECT lang, quality + 1 AS a, toxic + 1 AS b FROM labels "
          "JOIN documents USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL)")
oracle("kappa_grouped", f"""
SELECT lang, n, kappa, kappa_status, {_BAND}
FROM (SELECT lang, n, {_KAPPA_COLUMNS} FROM {kappa('a', 'b', 2, _RATED, 'lang')})""")

# ---- quality ----

oracle("dup_ids", """
SELECT 'conv_' || conv_id AS key, count(*) AS copies, 'conv_' || conv_id AS first_id
FROM conversations GROUP BY conv_id HAVING count(*) > 1""")

for _kind in ("source", "target", "pair"):
    _preview = ", min(preview) AS preview" if _kind == "source" else ""
    oracle(f"dup_{_kind}" if _kind != "pair" else "dup_pairs", f"""
SELECT {_kind}_key AS key, count(*) AS copies, min(record_id) AS first_id,
       count(DISTINCT benchmark) > 1 AS cross_benchmark{_preview}
FROM fx_hashes GROUP BY 1 HAVING count(*) > 1""", "fx_hashes")

oracle("dup_members", """
SELECT source_key AS key, count(*) OVER (PARTITION BY source_key) AS copies, record_id, benchmark
FROM fx_hashes QUALIFY count(*) OVER (PARTITION BY source_key) > 1""", "fx_hashes")

_GROUPS = "\nUNION ALL\n".join(
    f"SELECT '{k}' AS kind, count(*) AS n, count(DISTINCT benchmark) > 1 AS cross_b "
    f"FROM fx_hashes GROUP BY {c}"
    for k, c in (("id", "record_id"), ("source", "source_key"), ("target", "target_key"),
                 ("pair", "pair_key")))
oracle("dup_summary", f"""
SELECT kind, CAST(sum(n) AS bigint) AS records,
       count(*) FILTER (n > 1 AND cross_b) AS cross_groups,
       count(*) FILTER (n > 1 AND NOT cross_b) AS within_groups
FROM ({_GROUPS}) GROUP BY 1""", "fx_hashes")

# ---- sampling ----


def sampled(k: int, seed: int) -> str:
    return f"""
(SELECT * FROM fx_records SEMI JOIN fx_benchmarks USING (benchmark) WHERE status = 'pending'
 QUALIFY row_number() OVER (PARTITION BY benchmark, record_type
                            ORDER BY md5('{seed}:' || record_id), record_id) <= {k})"""


oracle("calibration_sample", f"""
SELECT 'cal_' || record_id AS record_id, benchmark, record_type, task_id, source_text,
       target_text, target_text AS suggested_text, 'pending' AS status
FROM {sampled(1, 42)} WHERE source_text <> '' AND target_text <> ''""",
       "fx_records", "fx_benchmarks")

oracle("calibration_composition", f"""
SELECT record_type, count(*) AS records FROM {sampled(2, 7)}
WHERE source_text <> '' AND target_text <> '' GROUP BY 1""", "fx_records", "fx_benchmarks")

oracle("empty_strata", """
SELECT benchmark, record_type
FROM (SELECT benchmark, unnest(['query', 'passage']) AS record_type FROM fx_benchmarks)
ANTI JOIN (SELECT * FROM fx_records WHERE status = 'pending') USING (benchmark, record_type)""",
       "fx_records", "fx_benchmarks")

oracle("sample_n", """
SELECT * FROM fx_passages ORDER BY md5('42:' || id), id LIMIT 100""", "fx_passages")

oracle("shuffled_order", """
SELECT row_number() OVER (ORDER BY md5('42:' || record_id), record_id) AS position,
       record_id, benchmark FROM fx_records""", "fx_records")

oracle("shuffled_table", """
SELECT row_number() OVER (ORDER BY md5('42:' || record_id), record_id) AS position,
       record_id, benchmark, md5(source_text) AS text_key FROM fx_records""", "fx_records")

oracle("required_submissions", """
SELECT greatest(count(*), 2) AS min_submitted FROM fx_users SEMI JOIN fx_members USING (user_id)
WHERE role <> 'owner'""", "fx_users", "fx_members")

oracle("derived_status", """
SELECT record_id, count(response_id) AS submitted,
       CASE WHEN count(response_id) >= 6 THEN 'completed' ELSE 'pending' END AS status
FROM fx_records LEFT JOIN (SELECT record_id, response_id FROM fx_responses
                           WHERE status = 'submitted') USING (record_id)
GROUP BY 1""", "fx_records", "fx_responses")

oracle("calibration_status", """
SELECT record_id, count(*) FILTER (status = 'submitted') AS submitted,
       CASE WHEN count(*) FILTER (status = 'submitted') >= (
                 SELECT greatest(count(*), 2) FROM fx_users SEMI JOIN fx_members USING (user_id)
                 WHERE role <> 'owner') THEN 'completed' ELSE 'pending' END AS status
FROM fx_cal GROUP BY 1""", "fx_cal", "fx_users", "fx_members")

# ---- maintenance ----

oracle("discards_preview", """
SELECT annotator, record_id, response_id FROM fx_named WHERE status = 'discarded'""", "fx_named")

oracle("discards_applied", """
SELECT response_id, record_id, user_id, status FROM fx_responses
WHERE status <> 'discarded'""", "fx_responses")

_MATCH = ("(SELECT 1 FROM fx_targets_reopen t WHERE t.record_id = p.record_id "
          "AND (t.annotator IS NULL OR t.annotator = p.annotator))")
oracle("reopen_preview", f"""
SELECT annotator, record_id, response_id, status, quality_score FROM fx_named p
WHERE EXISTS {_MATCH}""", "fx_named", "fx_targets_reopen")

oracle("reopen_applied", f"""
SELECT response_id, record_id, user_id, status FROM fx_named p
WHERE NOT EXISTS {_MATCH}""", "fx_named", "fx_targets_reopen")

oracle("responses_as_of", """
SELECT response_id, record_id, user_id, CASE WHEN version > 2 AND again THEN 'again' ELSE status END AS status, version
FROM (SELECT *, seq % 4 = 0 AS again FROM fx_answered), (SELECT unnest([1, 2, 3, 4]) AS version)
WHERE (version = 1 OR status <> 'discarded' OR (version > 2 AND again)) AND (version < 4 OR status <> 'draft')""",
       "fx_answered")

oracle("compacted", """
SELECT response_id, record_id, user_id, status FROM fx_answered
WHERE status = 'submitted' AND seq % 4 <> 0""", "fx_answered")
