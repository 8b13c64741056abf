"""The registered queries as plain SQL over the same tables.

Expected values are computed from the tables' columns, not by taking the JSON text apart again.
"""

from __future__ import annotations

from reqframe.plans.views import PRICES, REALTIME

_DOC = "printf('doc-%06d', doc_id)"
_CHAT = "'/v1/chat/completions'"

_PRICES = "prices(model, completion_window, input_price, output_price) AS (VALUES {})".format(
    ", ".join(f"('{m}', '{w}', {i}::DECIMAL(18,15), {o}::DECIMAL(18,15))" for m, w, i, o in PRICES)
)
_REALTIME = "realtime(model, input_price, output_price) AS (VALUES {})".format(
    ", ".join(f"('{m}', {i}::DECIMAL(18,15), {o}::DECIMAL(18,15))" for m, i, o in REALTIME)
)

# Result lines, one row per line.
_A = f"""a AS (
    SELECT doc_id + 1 AS line, doc_id, {_DOC} AS custom_id, source = 'src4' AS is_error, source <> 'src4' AS is_result,
           CASE WHEN source <> 'src4' THEN text END AS content,
           CASE WHEN source <> 'src4' THEN n_chars END AS prompt_tokens,
           CASE WHEN source <> 'src4' THEN doc_id END AS completion_tokens
    FROM documents)"""
_B_ID = f"CASE WHEN lang = 'fr' THEN printf('alt-%06d', doc_id) ELSE {_DOC} END"
_B_TEXT = "CASE WHEN lang = 'de' THEN text || ' (revised)' ELSE text END"
_B = f"""b AS (
    SELECT line, custom_id, is_error, NOT is_error AS is_result,
           CASE WHEN NOT is_error THEN content END AS content,
           CASE WHEN NOT is_error THEN content_kind END AS content_kind,
           CASE WHEN NOT is_error THEN n_chars END AS prompt_tokens,
           CASE WHEN NOT is_error THEN doc_id END AS completion_tokens
    FROM (
        SELECT doc_id * 2 + 1 AS line, {_B_ID} AS custom_id, source IN ('src0', 'src1') AS is_error,
               CASE source WHEN 'src2' THEN 'null'
                    WHEN 'src3' THEN '[{{"text":' || to_json(text) || ',"type":"text"}}]'
                    ELSE {_B_TEXT} END AS content,
               CASE source WHEN 'src2' THEN 'VOID' WHEN 'src3' THEN 'ARRAY' ELSE 'STRING' END AS content_kind,
               n_chars, doc_id
        FROM documents
        UNION ALL
        SELECT doc_id * 2 + 2, {_B_ID}, false, {_B_TEXT}, 'STRING', n_chars, doc_id FROM documents WHERE source = 'src1'))"""

_LAST = """
    last_a AS (SELECT custom_id, coalesce(arg_max(coalesce(content, ''), line), '') AS content, count(*) AS n FROM a GROUP BY custom_id),
    last_b AS (SELECT custom_id, coalesce(arg_max(coalesce(content, ''), line), '') AS content, count(*) AS n FROM b GROUP BY custom_id),
    per_id AS (
        SELECT coalesce(x.custom_id, y.custom_id) AS custom_id, x.n AS na, y.n AS nb,
               CASE WHEN y.custom_id IS NULL THEN 'only_in_a' WHEN x.custom_id IS NULL THEN 'only_in_b'
                    WHEN x.content = y.content THEN 'identical' ELSE 'different' END AS status
        FROM last_a x FULL JOIN last_b y ON x.custom_id = y.custom_id)"""

_DIFF_COUNTS = """
    SELECT count(na) AS entries_a, count(nb) AS entries_b,
           count(*) FILTER (status IN ('identical', 'different')) AS common,
           count(*) FILTER (status = 'identical') AS identical, count(*) FILTER (status = 'different') AS different,
           count(*) FILTER (status = 'only_in_a') AS only_in_a, count(*) FILTER (status = 'only_in_b') AS only_in_b,
           0::BIGINT AS parse_errors_a, 0::BIGINT AS missing_id_a, coalesce(sum(na - 1), 0)::BIGINT AS duplicates_a,
           0::BIGINT AS parse_errors_b, 0::BIGINT AS missing_id_b, coalesce(sum(nb - 1), 0)::BIGINT AS duplicates_b
    FROM per_id"""

# Findings per faulty source, in report order.
_FOUND = """found AS (
    SELECT doc_id, source, CASE source
        WHEN 'src0' THEN ['Missing required field: custom_id'] WHEN 'src1' THEN ['Missing required field: method']
        WHEN 'src2' THEN ['Missing required field: body']
        WHEN 'src3' THEN ['Missing required field: body.model'] WHEN 'src4' THEN ['Invalid JSON']
        WHEN 'src5' THEN ['Invalid JSON'] WHEN 'src6' THEN NULL
        WHEN 'src7' THEN ['Missing required field: custom_id', 'Missing required field: method',
                          'Missing required field: url', 'Missing required field: body']
        WHEN 'src8' THEN ['Missing required field: body.model'] ELSE [] END AS messages
    FROM documents)"""

_LOG = """log AS (
    SELECT event_id AS id, ts, 'm-' || event_type AS model, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
           round(value * 100)::BIGINT AS duration_ms, json_extract(props, '$.k')::BIGINT AS prompt,
           CASE WHEN event_type <> 'error' THEN round(value * 100)::BIGINT // 10 END AS ttfb_ms,
           CASE WHEN event_type <> 'signup' THEN 'batch-' || user_id END AS batch_id,
           CASE WHEN event_type <> 'view' THEN
               (json_extract(props, '$.k')::BIGINT * 0.000000150000000::DECIMAL(18,15)
                + 2 * json_extract(props, '$.k')::BIGINT * 0.000000600000001::DECIMAL(18,15))::DECIMAL(38,15) END AS cost
    FROM events)"""

_COST = "CAST(coalesce(sum(cost), 0)::DECIMAL(38,15) AS VARCHAR)"


def _usage(where: str, realtime: bool) -> str:
    extra = (
        """, CAST(coalesce(sum(prompt * r.input_price + 2 * prompt * r.output_price), 0)::DECIMAL(38,15) AS VARCHAR)
             AS estimated_realtime_cost"""
        if realtime
        else ""
    )
    return f"""WITH {_REALTIME}, {_LOG}
        SELECT sum(prompt)::BIGINT AS total_input_tokens, sum(2 * prompt)::BIGINT AS total_output_tokens,
               count(*) AS total_request_count, count(DISTINCT batch_id) AS total_batch_count,
               {_COST} AS total_cost{extra},
               coalesce(count(batch_id)::DOUBLE / nullif(count(DISTINCT batch_id), 0)::DOUBLE, 0.0) AS avg_requests_per_batch
        FROM log LEFT JOIN realtime r ON log.model = r.model WHERE {where}"""


_ANALYTICS = f"""SELECT batch_id, count(*) AS total_requests, sum(prompt)::BIGINT AS total_prompt_tokens,
        sum(2 * prompt)::BIGINT AS total_completion_tokens, sum(3 * prompt)::BIGINT AS total_tokens,
        avg(duration_ms) AS avg_duration_ms, avg(ttfb_ms) AS avg_ttfb_ms,
        CAST(sum(cost)::DECIMAL(38,15) AS VARCHAR) AS total_cost
    FROM log WHERE batch_id IS NOT NULL GROUP BY batch_id"""

_BATCHES = """batches AS (
    SELECT o_orderkey AS id, epoch(o_orderdate)::BIGINT AS created_at,
           CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'validating' END AS status,
           coalesce(total, 0) AS total, coalesce(failed, 0) AS failed, coalesce(ended, 0) AS ended
    FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS total, count(*) FILTER (l_linestatus = 'F') AS ended,
               count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS failed
        FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""

_FILES = """files AS (
    SELECT 'file-' || s_suppkey AS id, round(s_acctbal * 100)::BIGINT AS bytes, s_suppkey AS created_at, s_name AS filename,
           CASE WHEN s_acctbal < 0 THEN 'batch_error' WHEN s_acctbal < 5000 THEN 'batch_output' ELSE 'batch' END AS purpose
    FROM supplier)"""

_MODEL_ID = "printf('00000000-0000-0000-0000-%012d', {})"
_MODELS = f"""models AS (
    SELECT {_MODEL_ID.format('p_partkey')} AS id, p_name AS alias, p_type AS model_type FROM part)"""

_IDS = """ids AS (
    SELECT 100 - n AS ordinal, 'batch-src' || n AS id FROM (SELECT DISTINCT substring(source, 4)::BIGINT AS n FROM documents)
    UNION ALL
    SELECT 200 - n, 'batch-src' || n FROM (SELECT DISTINCT substring(source, 4)::BIGINT AS n FROM documents)
    UNION ALL SELECT 300, 'batch-none')"""


def _chat(max_tokens: str = "n_chars", model: str = "'m-' || lang", more: str = "", where: str = "true") -> str:
    return f"""SELECT {_DOC} AS custom_id, {model} AS model, text AS content,
        ({max_tokens})::BIGINT AS max_tokens{more} FROM documents WHERE {where}"""


def _estimate(window: str) -> str:
    return f"""WITH {_PRICES}, per_model AS (
            SELECT 'm-' || lang AS model, count(*) AS request_count, (sum(strlen(text)) // 4)::BIGINT AS input_tokens,
                   sum(n_chars)::BIGINT AS output_tokens
            FROM documents GROUP BY lang),
        estimate AS (
            SELECT m.*, (input_tokens * input_price + output_tokens * output_price)::DECIMAL(38,15) AS cost
            FROM per_model m LEFT JOIN prices p ON p.model = m.model AND completion_window = '{window}')"""


def _in_order(model: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, {_DOC} AS custom_id, {model} AS model FROM documents"""


_EIGHTHS = """parts AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)
        // (SELECT greatest(1, ceil(count(*) / {}.0))::BIGINT FROM documents) AS part FROM documents)"""

ORACLES: dict[str, str] = {
    "scan_directory": _in_order("'m-' || lang"),
    "split_then_merge": _in_order("'m-' || lang"),
    "prepare_folder": _in_order("'m-new'"),
    "read_id_list": """SELECT 0::BIGINT AS ordinal, 'first' AS id UNION ALL SELECT 1, 'second'
        UNION ALL SELECT row_number() OVER (ORDER BY doc_id) + 1, 'doc-' || doc_id FROM documents""",
    "prepared_files": f"""WITH {_EIGHTHS.format(8)}
        SELECT 'set [' || part || '] a+b%20.jsonl' AS file, count(*) FILTER (NOT contains({_DOC}, 'doc-00000')) + 1 AS lines FROM parts GROUP BY part
        UNION ALL SELECT 'set [9] empty.jsonl', 1""",
    "split_files": f"""WITH {_EIGHTHS.format(7)}
        SELECT printf('my ids-%03d.jsonl', part + 1) AS file, count(*) AS lines, sum(strlen({_DOC}) + 1)::BIGINT AS bytes FROM parts GROUP BY part""",
    "report_json": f"""SELECT '{{"file_a":"run a.jsonl","file_b":"run b.jsonl","entries_a":' || entries_a || ',"entries_b":' || entries_b
        || ',"common":' || common || ',"identical_responses":' || identical || ',"different_responses":' || different
        || ',"only_in_a":' || only_in_a || ',"only_in_b":' || only_in_b
        || CASE WHEN duplicates_a > 0 THEN ',"warnings_a":{{"parse_errors":0,"missing_id":0,"duplicates":' || duplicates_a || '}}' ELSE '' END
        || CASE WHEN duplicates_b > 0 THEN ',"warnings_b":{{"parse_errors":0,"missing_id":0,"duplicates":' || duplicates_b || '}}' ELSE '' END
        || '}}' AS value FROM (WITH {_A}, {_B}, {_LAST} {_DIFF_COUNTS})""",
    "stats_report_json": """WITH lines AS (
            SELECT lang, strlen(text) AS size, false AS bad FROM documents
            UNION ALL SELECT CASE WHEN source NOT IN ('src2', 'src3', 'src4', 'src5', 'src7', 'src8') THEN lang END,
                CASE WHEN source NOT IN ('src2', 'src4', 'src5', 'src7', 'src8') THEN strlen(text) ELSE 0 END, source IN ('src4', 'src5')
            FROM documents WHERE source <> 'src6'),
        models AS (SELECT 'm-' || lang AS model, count(*) AS n FROM lines WHERE lang IS NOT NULL GROUP BY lang)
        SELECT '{"lines":' || count(*) || ',"models":{' || (SELECT string_agg('"' || model || '":' || n, ',' ORDER BY model) FROM models)
            || '},"estimated_input_tokens":' || (sum(size) // 4)::BIGINT || ',"parse_errors":' || count(*) FILTER (bad) || '}' AS value FROM lines""",
    "build_requests": _chat(more=f", 'POST' AS method, {_CHAT} AS url, 'user' AS role"),
    "build_numbered": "SELECT printf('request-%04d', row_number() OVER (ORDER BY doc_id) - 1) AS custom_id, doc_id FROM documents",
    "build_chat": """SELECT 'turn-' || conv_id || '-' || turn AS custom_id, 'Speak as the ' || role AS system,
        'Turn: ' || text AS content, 200 AS max_tokens, 'json_object' AS format FROM conversations""",
    "build_embeddings": """SELECT printf('emb-%03d', doc_id) AS custom_id, '/v1/embeddings' AS url, 'm-' || lang AS model,
        text AS input FROM documents""",
    "next_stage_requests": f"""WITH {_A} SELECT printf('stage2-%04d', doc_id) AS custom_id, 'm-next' AS model,
        'Source record <' || coalesce(content, '') || '> Which numbers does it state?' AS content,
        256::BIGINT AS max_tokens FROM a""",
    "request_stats": """SELECT count(*) AS lines, count(*) FILTER (source IN ('src4', 'src5')) AS parse_errors,
        (sum(CASE WHEN source NOT IN ('src2', 'src4', 'src5', 'src7', 'src8') THEN strlen(text) ELSE 0 END) // 4)::BIGINT
            AS estimated_input_tokens
        FROM documents WHERE source <> 'src6'""",
    "multimodal_stats": """SELECT count(*) AS lines, 0::BIGINT AS parse_errors,
        (sum(strlen(url)) // 4)::BIGINT AS estimated_input_tokens FROM pages""",
    "requests_per_model": """SELECT 'm-' || lang AS model, count(*) AS requests, row_number() OVER (ORDER BY 'm-' || lang) - 1 AS position
        FROM documents GROUP BY lang""",
    "cost_estimate": f"""{_estimate('24h')} SELECT model, request_count, input_tokens AS estimated_input_tokens,
        output_tokens AS estimated_output_tokens, CAST(cost AS VARCHAR) AS estimated_cost FROM estimate""",
    "cost_estimate_totals": f"""{_estimate('1h')} SELECT sum(request_count)::BIGINT AS total_requests,
        sum(input_tokens)::BIGINT AS total_estimated_input_tokens, sum(output_tokens)::BIGINT AS total_estimated_output_tokens,
        {_COST} AS total_estimated_cost FROM estimate""",
    "validate_depth": """SELECT 'nested.jsonl' AS file, doc_id + 1 AS line, 0 AS rule, 'Invalid JSON' AS message
        FROM documents WHERE 112 + n_chars % 30 > 127""",
    "validate_errors": f"""WITH {_FOUND} SELECT source || '.jsonl' AS file, doc_id + 1 AS line,
        unnest(generate_series(0, len(messages) - 1)) AS rule, unnest(messages) AS message FROM found WHERE len(messages) > 0""",
    "validate_files": f"""WITH {_FOUND} SELECT source || '.jsonl' AS file, sum(len(messages))::BIGINT AS errors,
        sum(len(messages)) = 0 AS valid FROM found WHERE messages IS NOT NULL GROUP BY source""",
    "prepare_model": _chat(model="'m-new'"),
    "prepare_params": _chat(max_tokens="50", more=", 0.5::DOUBLE AS temperature, 0.9::DOUBLE AS top_p"),
    "prepare_set_path": """SELECT false AS stream, 7::BIGINT AS run, 'a=b' AS tag, '{"x":1}' AS method, '{"y":2}' AS custom_id,
        text AS content FROM documents""",
    "prepare_remove": _chat(where=f"NOT contains({_DOC}, '1')"),
    "prepare_append": f"""SELECT 'requests.jsonl' AS file, 0 AS section, doc_id + 1 AS line, {_DOC} AS custom_id FROM documents
        UNION ALL SELECT 'requests.jsonl', 1, 1, 'extra-1' UNION ALL SELECT 'requests.jsonl', 1, 2, 'extra-2'""",
    "inline_assets": """SELECT printf('page-%06d', page_id) AS custom_id, url AS text,
        'data:image/' || CASE regexp_extract(url, '[^/]\\.([^./]*)$', 1) WHEN 'png' THEN 'png' WHEN 'jpg' THEN 'jpeg'
            WHEN 'jpeg' THEN 'jpeg' WHEN 'gif' THEN 'gif' WHEN 'webp' THEN 'webp' WHEN 'svg' THEN 'svg+xml' ELSE 'png' END
            || ';base64,' || to_base64(encode(html)) AS uri, 'data:image/png;base64,AA==' AS kept FROM pages""",
    "merge_lines": f"""SELECT doc_id AS merged_seq, 0 AS set_ord, doc_id + 1 AS line, {_DOC} AS custom_id FROM documents
        UNION ALL SELECT doc_id + (SELECT count(*) FROM documents), 1, doc_id + 1, {_DOC} FROM documents""",
    "split_chunks": f"""SELECT {_DOC} AS custom_id, n // 100 + 1 AS chunk, printf('documents-%03d', n // 100 + 1) AS chunk_name
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)""",
    "chunk_sizes": """SELECT printf('documents-%03d', n // 300 + 1) AS chunk_name, count(*) AS lines
        FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents) GROUP BY 1""",
    "sample_k": f"""SELECT doc_id + 1 AS line, {_DOC} AS custom_id FROM documents ORDER BY md5('7:' || (doc_id + 1)) LIMIT 100""",
    "sample_large": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INT AS l_quantity FROM lineitem
        ORDER BY md5('3:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || l_quantity::INT)
        LIMIT 25000""",
    "results_concat": f"""WITH {_IDS} SELECT ordinal, doc_id AS line, 'batch-' || source AS batch_id, {_DOC} AS custom_id
        FROM documents JOIN ids ON ids.id = 'batch-' || source""",
    "results_missing": f"""WITH {_IDS} SELECT ordinal, id FROM ids WHERE id NOT IN
        (SELECT 'batch-' || source FROM documents WHERE lang = 'en')""",
    "results_page": f"""SELECT doc_id AS pos, {_DOC} AS custom_id, (SELECT max(doc_id) + 1 FROM documents) > 350 AS incomplete,
        least((SELECT max(doc_id) + 1 FROM documents), 350) AS last_line FROM documents WHERE doc_id >= 100 AND doc_id < 350""",
    "results_page_failed": f"""WITH f AS (
            SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, count(*) OVER () AS total FROM documents WHERE source = 'src4')
        SELECT doc_id AS pos, {_DOC} AS custom_id, total > 35 AS incomplete, least(total, 35)::BIGINT AS last_line
        FROM f WHERE n > 10 AND n <= 35""",
    "results_extract": f"""WITH {_B} SELECT line, custom_id, content, content_kind, prompt_tokens, completion_tokens,
        prompt_tokens + completion_tokens AS total_tokens, is_result, is_error FROM b""",
    "results_structured": """SELECT printf('event-%08d', event_id) AS custom_id,
        CASE WHEN event_type <> 'error' THEN json_extract(props, '$.k')::BIGINT END AS k, event_type = 'error' AS bad_content
        FROM events""",
    "result_error_counts": f"""WITH {_B} SELECT count(*) FILTER (is_result) AS results, count(*) FILTER (is_error) AS errors,
        0::BIGINT AS neither FROM b""",
    "diff_summary": f"WITH {_A}, {_B}, {_LAST} {_DIFF_COUNTS}",
    "diff_strict": f"WITH {_A}, {_B.replace('CASE WHEN NOT is_error THEN content END AS content', 'NULL::VARCHAR AS content')}, {_LAST} {_DIFF_COUNTS}",
    "diff_detail": f"WITH {_A}, {_B}, {_LAST} SELECT custom_id, status FROM per_id",
    "diff_warnings": f"""WITH ids AS (
            SELECT {_DOC} AS id FROM documents WHERE source NOT IN ('src0', 'src4', 'src5', 'src6', 'src7', 'src9')
            UNION ALL SELECT {_DOC} FROM documents)
        SELECT (SELECT count(*) FROM documents WHERE source IN ('src4', 'src5')) AS parse_errors,
               (SELECT count(*) FROM documents WHERE source IN ('src0', 'src7', 'src9')) AS missing_id,
               count(*) - count(DISTINCT id) AS duplicates FROM ids""",
    "only_in_a": f"WITH {_A}, {_B} SELECT DISTINCT custom_id FROM a WHERE custom_id NOT IN (SELECT custom_id FROM b)",
    "compare_runs": f"""WITH {_A}, {_B},
            first_b AS (SELECT custom_id, min(line) AS line FROM b GROUP BY custom_id)
        SELECT a.custom_id, d.text AS prompt, coalesce(a.content, '(no response)') AS a_content,
               a.prompt_tokens AS a_prompt_tokens, a.completion_tokens AS a_completion_tokens,
               CASE WHEN b.content_kind <> 'VOID' THEN b.content ELSE '(no response)' END AS b_content,
               b.prompt_tokens AS b_prompt_tokens, b.completion_tokens AS b_completion_tokens
        FROM a JOIN documents d ON d.doc_id = a.doc_id
        LEFT JOIN first_b f ON f.custom_id = a.custom_id LEFT JOIN b ON b.line = f.line""",
    "match_results": f"""WITH {_B} SELECT {_DOC} AS custom_id, doc_id + 1 AS request_line, b.line AS result_line, content,
        prompt_tokens, completion_tokens, is_result, is_error FROM documents LEFT JOIN b ON b.custom_id = {_DOC}""",
    "retry_set": f"""WITH {_B} SELECT doc_id + 1 AS line, {_DOC} AS custom_id FROM documents
        WHERE {_DOC} IN (SELECT custom_id FROM b WHERE is_error) AND {_DOC} NOT IN (SELECT custom_id FROM b WHERE is_result)""",
    "usage_totals": _usage("true", True),
    "usage_between": _usage("ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:30:00'", False),
    "usage_by_model": f"""WITH {_LOG} SELECT model, sum(prompt)::BIGINT AS input_tokens, sum(2 * prompt)::BIGINT AS output_tokens,
        {_COST} AS cost, count(*) AS request_count FROM log GROUP BY model""",
    "usage_plain": f"""WITH {_LOG} SELECT concat_ws(chr(9), model, count(*), sum(prompt)::BIGINT, sum(2 * prompt)::BIGINT, {_COST})
        AS value FROM log GROUP BY model""",
    "batch_analytics": f"WITH {_LOG} {_ANALYTICS}",
    "batch_analytics_list": f"""WITH {_LOG}, analytics AS ({_ANALYTICS}), users AS (SELECT DISTINCT user_id FROM events),
            ids AS (SELECT 1000 - user_id AS ordinal, 'batch-' || user_id AS batch_id FROM users
                    UNION ALL SELECT 5000 - user_id, 'batch-' || user_id FROM users UNION ALL SELECT 0, 'batch-none')
        SELECT i.ordinal, i.batch_id, coalesce(total_requests, 0) AS total_requests,
               coalesce(total_prompt_tokens, 0) AS total_prompt_tokens,
               coalesce(total_completion_tokens, 0) AS total_completion_tokens, coalesce(total_tokens, 0) AS total_tokens,
               avg_duration_ms, avg_ttfb_ms, total_cost
        FROM ids i LEFT JOIN analytics a ON a.batch_id = i.batch_id""",
    "requests_filtered": f"""WITH {_LOG} SELECT id, model, status_code, 3 * prompt AS total_tokens,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM log WHERE model = 'm-purchase' AND status_code = 200
        AND ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-25 00:00:00'""",
    "requests_page": f"""WITH {_LOG}, placed AS (SELECT *, row_number() OVER (ORDER BY ts DESC, id DESC) - 1 AS position FROM log)
        SELECT position, id, model, duration_ms FROM placed WHERE position >= 40 AND position < 60""",
    "requests_deep_page": f"""WITH {_LOG}, placed AS (
            SELECT *, row_number() OVER (ORDER BY ts DESC, id DESC) - 1 AS position, count(*) OVER () // 2 AS half FROM log)
        SELECT position, id, model, duration_ms FROM placed WHERE position >= half AND position < half + 50""",
    "batch_progress": f"""WITH {_BATCHES} SELECT id, status, ended AS done, CASE WHEN total > 0 THEN ended::DOUBLE / total END AS progress,
        ended || '/' || total AS progress_text FROM batches""",
    "results_progress": """SELECT 'batch-' || source AS id, count(*) AS total, count(*) FILTER (source <> 'src4') AS completed,
        count(*) FILTER (source = 'src4') AS failed, 1.0::DOUBLE AS progress, count(*) || '/' || count(*) AS progress_text
        FROM documents GROUP BY source""",
    "results_progress_retried": """SELECT 'batch-' || source AS id, count(*) AS total, count(*) FILTER (source <> 'src4' OR lang = 'en') AS completed,
        count(*) FILTER (source = 'src4' AND lang IS DISTINCT FROM 'en') AS failed, 1.0::DOUBLE AS progress,
        count(*) || '/' || count(*) AS progress_text FROM documents GROUP BY source""",
    "watch_verdict": f"""WITH {_BATCHES} SELECT count(*) AS watched, count(*) FILTER (status <> 'completed') AS open,
        count(*) FILTER (status = 'completed' AND failed > 0) AS ended_badly,
        count(*) FILTER (status = 'completed' AND failed > 0) > 0 AS run_failed FROM batches""",
    "batches_active_first": f"""WITH {_BATCHES} SELECT id, status, created_at,
        row_number() OVER (ORDER BY status IN ('in_progress', 'validating') DESC, created_at DESC, id DESC) - 1 AS position FROM batches""",
    "batches_cursor_page": f"""WITH {_BATCHES}, c AS (SELECT created_at AS cc, id AS ci FROM batches WHERE id = 5),
            rest AS (SELECT id, status, created_at FROM batches, c WHERE created_at < cc OR (created_at = cc AND id < ci))
        SELECT id, status, created_at, (SELECT count(*) FROM rest) > 50 AS has_more FROM rest
        ORDER BY created_at DESC, id DESC LIMIT 50""",
    "batches_active_page": f"""WITH {_BATCHES} SELECT id, status, (SELECT count(*) FROM batches) > 100 AS has_more FROM batches
        ORDER BY status IN ('in_progress', 'validating') DESC, created_at DESC, id DESC LIMIT 100""",
    "page_info": f"""WITH {_BATCHES}, p AS (SELECT * FROM batches ORDER BY created_at DESC, id DESC LIMIT 20)
        SELECT (SELECT count(*) FROM batches) > 20 AS has_more, arg_max(id, (created_at, id)) AS first_id,
               arg_min(id, (created_at, id)) AS last_id, count(*) AS rows FROM p""",
    "files_by_purpose": f"WITH {_FILES} SELECT * FROM files WHERE purpose = 'batch'",
    "files_listed": f"""WITH {_FILES} SELECT *, row_number() OVER (ORDER BY created_at DESC, id DESC) - 1 AS position,
        false AS has_more FROM files""",
    "models_by_type": f"WITH {_MODELS} SELECT * FROM models WHERE lower(model_type) = 'promo'",
    "resolve_models": f"""WITH {_MODELS}, asked AS (
            SELECT upper({_MODEL_ID.format('l_partkey')}) AS model, {_MODEL_ID.format('l_partkey')} AS as_id, NULL AS as_alias FROM lineitem
            UNION ALL SELECT upper(p_name), NULL, lower(p_name) FROM part UNION ALL SELECT c_name, NULL, lower(c_name) FROM customer),
            aliases AS (SELECT lower(alias) AS alias, min(id) AS id FROM models GROUP BY 1)
        SELECT model, coalesce(m.id, x.id) AS model_id FROM asked LEFT JOIN models m ON m.id = as_id
        LEFT JOIN aliases x ON x.alias = as_alias""",
    "stream_results": f"""WITH {_A} SELECT 'batch-' || source AS batch_id, custom_id, content, is_error
        FROM a JOIN documents d ON d.doc_id = a.doc_id""",
    "stream_progress": """SELECT 'batch-' || source AS batch_id, count(*) AS done, count(*) FILTER (source = 'src4') AS failed,
        count(*) AS total, 100::BIGINT AS percent FROM documents GROUP BY source""",
    "stream_progress_retried": """SELECT 'batch-' || source AS batch_id, count(*) AS done,
        count(*) FILTER (source = 'src4' AND lang IS DISTINCT FROM 'en') AS failed FROM documents GROUP BY source""",
    "stream_terminal": """SELECT DISTINCT l_orderkey || '-' || l_returnflag AS batch_id,
        CASE WHEN l_returnflag = 'R' THEN 'batch.failed' ELSE 'batch.completed' END AS event FROM lineitem WHERE l_linestatus = 'F'""",
}
