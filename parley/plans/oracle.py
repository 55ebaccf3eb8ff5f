"""DuckDB SQL that states each query independently of the engine."""

from __future__ import annotations

INTER = """inter AS (
  SELECT e.event_id, 'u' || e.user_id AS userid, CASE WHEN e.k <> 0 THEN 'c' || e.k END AS campaign, e.ts AS timestamp
  FROM (SELECT *, CAST(props->>'$.k' AS INT) AS k FROM events) e)"""

WHOLE = INTER + """, whole AS (
  SELECT i.*, d.text AS message FROM inter i
  LEFT JOIN documents d ON d.doc_id = i.event_id % (SELECT count(*) FROM documents))"""

MSG = WHOLE + """, msg AS (
  SELECT event_id, userid, campaign, timestamp, message,
    sha256(userid || '|' || coalesce(campaign, 'None') || '|' || CAST(timestamp AS VARCHAR) || '|'
      || coalesce(message, 'None')) AS message_id
  FROM whole)"""

DOCUMENT_CELLS = r"""tok AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
    lambda t: t <> '')) AS t FROM documents),
  code AS (SELECT doc_id, h % 64 AS pos, CASE WHEN (h // 64) % 2 = 0 THEN 1 ELSE -1 END AS s
    FROM (SELECT doc_id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) AS h FROM tok)),
  cell AS (SELECT doc_id, pos, sum(s)::DOUBLE AS v FROM code GROUP BY ALL),
  norm AS (SELECT doc_id, sqrt(sum(v * v)) AS l FROM cell GROUP BY 1)"""

DOCUMENT_VECTORS = """vec AS (SELECT d.doc_id, list(coalesce(CASE WHEN n.l > 0 THEN c.v / n.l END, 0)::FLOAT ORDER BY p.pos) AS embedding
    FROM documents d CROSS JOIN (SELECT unnest(range(64)) AS pos) p
    LEFT JOIN cell c ON c.doc_id = d.doc_id AND c.pos = p.pos LEFT JOIN norm n ON n.doc_id = d.doc_id GROUP BY d.doc_id)"""

EMB = MSG + f""", {DOCUMENT_CELLS}, {DOCUMENT_VECTORS},
  emb AS (SELECT m.*, v.embedding FROM msg m JOIN vec v ON v.doc_id = m.event_id % (SELECT count(*) FROM documents))"""

ORD = """ord AS (
  SELECT 'u' || o_custkey AS userid, o_orderpriority AS campaign, o_orderdate AS timestamp FROM orders)"""

TIER = "CASE WHEN {n} > 10 THEN 'high' WHEN {n} > 5 THEN 'medium' ELSE 'low' END"


def engagement(view: str) -> str:
    return f"""
  pairs AS (SELECT userid, campaign, min(timestamp) AS f FROM {view} WHERE campaign IS NOT NULL GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY userid ORDER BY f, campaign) AS r FROM pairs),
  tops AS (SELECT userid, string_agg(campaign, ',' ORDER BY r) AS preferred FROM ranked WHERE r <= 3 GROUP BY userid),
  eng AS (SELECT t.userid AS user_id, t.n AS message_count, {TIER.format(n='t.n')} AS engagement_score,
      t.last_active, coalesce(p.preferred, '') AS preferred_campaigns
    FROM (SELECT userid, count(*) AS n, max(timestamp) AS last_active FROM {view} GROUP BY userid) t
    LEFT JOIN tops p USING (userid))"""


ENG_COLUMNS = "user_id, message_count, engagement_score, CAST(last_active AS VARCHAR) AS last_active, preferred_campaigns"

PERF = """perf AS (SELECT campaign AS campaign_id, count(*) AS total_messages, count(DISTINCT userid) AS unique_users,
  0.75::DOUBLE AS avg_sentiment, CAST(max(timestamp) AS VARCHAR) AS last_updated FROM inter GROUP BY campaign)"""

DAILY = """daily AS (SELECT CAST(timestamp AS DATE) AS activity_date, userid AS user_id, count(*) AS message_count,
  coalesce(string_agg(DISTINCT campaign, ',' ORDER BY campaign), '') AS campaigns_interacted FROM inter GROUP BY ALL)"""

PAIRS = "pairs AS (SELECT DISTINCT userid, campaign FROM inter WHERE campaign IS NOT NULL)"

SQL_DISTANCE = (
    "list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))"
)

CENTROIDS = """spread AS (SELECT userid, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM emb),
  cents AS (SELECT userid, list(v ORDER BY pos) AS centroid
    FROM (SELECT userid, pos, avg(v) AS v FROM spread GROUP BY ALL) GROUP BY userid)"""

SIMILAR = f"""{CENTROIDS},
  gaps AS (SELECT c.userid AS q, e.userid AS u, e.message_id AS id, {SQL_DISTANCE.format(a='c.centroid', b='e.embedding')} AS d
    FROM cents c, emb e),
  pool AS (SELECT * FROM gaps QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, id) <= 50),
  fold AS (SELECT q, u, count(*) AS hits, list_reduce(list(d ORDER BY d, id), lambda a, b: (a + b) / 2) AS s
    FROM pool WHERE u <> q GROUP BY q, u),
  sim AS (SELECT q, u, hits, s, 1 / (1 + s) AS similarity, row_number() OVER (PARTITION BY q ORDER BY s, u) AS rank
    FROM fold QUALIFY rank <= 5)"""

SCORED = f"""{SIMILAR},
  epairs AS (SELECT DISTINCT userid, campaign FROM emb WHERE campaign IS NOT NULL),
  freq AS (SELECT campaign, count(*) AS n FROM emb WHERE campaign IS NOT NULL GROUP BY campaign),
  peers AS (SELECT q, count(*) AS peers FROM sim GROUP BY q),
  cand AS (SELECT s.q, p.campaign, count(*) AS user_count,
      list_reduce(list(s.similarity ORDER BY s.rank), lambda a, b: a + b) / count(*) AS similarity_score,
      array_to_string(list(s.u ORDER BY s.rank)[1:3], ',') AS similar_users
    FROM sim s JOIN epairs p ON p.userid = s.u GROUP BY ALL),
  parts AS (SELECT c.*, p.peers, f.n / max(f.n) OVER (PARTITION BY c.q) AS engagement_frequency
    FROM cand c JOIN peers p USING (q) JOIN freq f USING (campaign)),
  scored AS (SELECT *, 0.3 * similarity_score + 0.2 * least(user_count / peers, 1.0) + 0.5 * engagement_frequency AS score
    FROM parts),
  recs AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, user_count DESC, campaign) AS rank
    FROM scored QUALIFY rank <= 5)"""

REC_COLUMNS = """q AS user_id, campaign AS campaign_id, round(score, 6) AS score,
  round(least(1.2 * score, 1.0), 6) AS confidence, CAST(rank AS BIGINT) AS rank,
  round(similarity_score, 6) AS similarity_score, user_count, round(engagement_frequency, 6) AS engagement_frequency,
  similar_users"""

EXPLAIN = "'Recommended because ' || user_count || ' similar users engaged with this campaign' AS explanation"

QUALITY = WHOLE + """, checked AS (
  SELECT w.*, v.embedding FROM whole w LEFT JOIN embeddings v ON v.vec_id = w.event_id)"""

HISTORY = "timestamp < TIMESTAMP '2024-01-21'"
ARRIVING = "timestamp >= TIMESTAMP '2024-01-11'"

STEPS = """steps AS (SELECT 'r' || user_id AS run_id, event_type AS step_name, value AS duration_seconds,
  2 * CAST(props->>'$.k' AS BIGINT) AS input_count, CAST(props->>'$.k' AS BIGINT) AS output_count, ts AS timestamp,
  event_id AS seq FROM events)"""

RUNS = """runs AS (SELECT 'r' || o_custkey AS run_id,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'running' END AS status,
  o_totalprice / 1000 AS total_duration_seconds, o_orderdate AS start_time, o_orderkey AS seq FROM orders)"""


def latency(where: str) -> str:
    return f"""WITH recent AS (SELECT event_type AS endpoint, value / 1000 * 1000 AS ms FROM events WHERE {where}),
  sorted AS (SELECT endpoint, list(ms ORDER BY ms) AS l, count(*) AS n, avg(ms) AS a FROM recent GROUP BY endpoint)
SELECT endpoint, n AS count, round(a, 6) AS avg_latency_ms, round(l[floor(n * 0.5)::BIGINT + 1], 6) AS p50_latency_ms,
  round(l[floor(n * 0.95)::BIGINT + 1], 6) AS p95_latency_ms, round(l[floor(n * 0.99)::BIGINT + 1], 6) AS p99_latency_ms
FROM sorted"""


def upsert_documents_sql(select: str) -> str:
    return f"""WITH {MSG},
  old AS (SELECT message_id, userid, '2024-02-01' AS processed FROM msg WHERE {HISTORY}),
  new AS (SELECT message_id, userid, '2024-02-02' AS processed FROM msg WHERE {ARRIVING})
{select}"""


SQL: dict[str, str] = {
    "ingest_clean": f"""WITH {WHOLE}
SELECT userid, campaign, CAST(timestamp AS VARCHAR) AS timestamp, md5(substr(message, 1, 1000)) AS message_md5,
  length(substr(message, 1, 1000)) AS message_length
FROM (SELECT DISTINCT userid, campaign, timestamp, message FROM whole) WHERE message IS NOT NULL""",
    "time_parse": "SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS parsed FROM events",
    "message_ids": f"WITH {MSG} SELECT event_id, message_id FROM msg",
    "user_engagement": f"WITH {INTER}, {engagement('inter')} SELECT {ENG_COLUMNS} FROM eng",
    "user_engagement_tiers": f"WITH {ORD}, {engagement('ord')} SELECT {ENG_COLUMNS} FROM eng",
    "campaign_performance": f"WITH {INTER}, {PERF} SELECT * FROM perf",
    "daily_activity": f"""WITH {INTER}, {DAILY}
SELECT CAST(activity_date AS VARCHAR) AS activity_date, user_id, message_count, campaigns_interacted FROM daily""",
    "report_summary": f"""WITH {ORD}, {engagement('ord')}
SELECT (SELECT count(DISTINCT userid) FROM ord) AS total_users, (SELECT count(*) FROM (SELECT DISTINCT campaign FROM ord))
  AS total_campaigns, (SELECT count(*) FROM ord) AS total_messages,
  (SELECT round(avg(CASE engagement_score WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END), 6) FROM eng)
  AS avg_engagement_score""",
    "messages_last_7_days": f"""WITH {INTER} SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS activity_date,
  count(*) AS message_count FROM inter GROUP BY 1 ORDER BY 1 DESC LIMIT 7""",
    "daily_trend": f"""WITH {INTER}, {DAILY} SELECT CAST(activity_date AS VARCHAR) AS activity_date,
  count(DISTINCT user_id) AS active_users, CAST(sum(message_count) AS BIGINT) AS messages
FROM daily GROUP BY 1 ORDER BY 1 DESC LIMIT 7""",
    "campaign_engagement_frequency": f"""WITH {INTER} SELECT campaign AS campaign_id, count(*) AS engagement_count,
  count(DISTINCT userid) AS unique_users, CAST(max(timestamp) AS VARCHAR) AS last_engagement FROM inter GROUP BY campaign""",
    "campaign_freq_lookup": f"""WITH {INTER} SELECT campaign AS campaign_id, count(*) AS engagement_count,
  count(DISTINCT userid) AS unique_users, CAST(max(timestamp) AS VARCHAR) AS last_engagement FROM inter
WHERE campaign IN ('c1', 'c2', 'c3', 'c50', 'c99', 'none') GROUP BY campaign""",
    "most_engaged_users": f"""WITH {INTER}, {engagement('inter')}
SELECT {ENG_COLUMNS} FROM eng ORDER BY message_count DESC, user_id LIMIT 5""",
    "best_campaigns": f"""WITH {INTER}, {PERF}
SELECT * FROM perf ORDER BY total_messages DESC, campaign_id NULLS LAST LIMIT 5""",
    "analytics_report_rows": f"""WITH {INTER}, {engagement('inter')}, {PERF},
  byday AS (SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS d, CAST(count(*) AS VARCHAR) AS n,
    CAST(count(DISTINCT userid) AS VARCHAR) AS u FROM inter GROUP BY 1 ORDER BY 1 DESC LIMIT 7)
SELECT 'summary' AS section, 'total_users' AS key, CAST(count(DISTINCT userid) AS VARCHAR) AS value FROM inter
UNION ALL SELECT 'summary', 'total_campaigns', CAST((SELECT count(*) FROM perf) AS VARCHAR)
UNION ALL SELECT 'summary', 'total_messages', CAST(count(*) AS VARCHAR) FROM inter
UNION ALL SELECT 'summary', 'avg_engagement_score', CAST(avg(CASE engagement_score WHEN 'high' THEN 3 WHEN 'medium'
  THEN 2 ELSE 1 END) AS VARCHAR) FROM eng
UNION ALL (SELECT 'users', user_id, CAST(message_count AS VARCHAR) FROM eng ORDER BY message_count DESC, user_id LIMIT 5)
UNION ALL (SELECT 'campaigns', campaign_id, CAST(total_messages AS VARCHAR) FROM perf
  ORDER BY total_messages DESC, campaign_id NULLS LAST LIMIT 5)
UNION ALL SELECT 'days', d, n FROM byday UNION ALL SELECT 'active', d, u FROM byday""",
    "document_stats": f"""WITH {INTER} SELECT count(*) AS total_documents,
  (SELECT count(*) FROM (SELECT DISTINCT userid FROM inter)) AS unique_users,
  (SELECT count(*) FROM (SELECT DISTINCT campaign FROM inter)) AS unique_campaigns FROM inter""",
    "validate_schema": f"""WITH {QUALITY} SELECT 'Found ' || n || ' null values in required field: campaign' AS error
FROM (SELECT count(*) FILTER (campaign IS NULL) AS n FROM checked) WHERE n > 0
UNION ALL SELECT 'Found ' || n || ' empty values in required field: message'
FROM (SELECT count(*) FILTER (trim(message) = '') AS n FROM checked) WHERE n > 0""",
    "validate_embeddings": f"""WITH {QUALITY} SELECT count(*) AS total_records,
  count(*) FILTER (embedding IS NULL) AS null_embeddings, count(*) FILTER (len(embedding) = 0) AS empty_embeddings,
  64 AS expected_dim, count(*) FILTER (len(embedding) <> 64) AS wrong_dimension,
  count(*) FILTER (len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) > 0) AS bad_values FROM checked""",
    "detect_anomalies": f"""WITH {QUALITY}, c AS (SELECT
  count(*) FILTER (embedding IS NULL OR len(embedding) = 0) AS empty_embeddings, 0::BIGINT AS missing_relationships,
  count(*) FILTER (timestamp IS NULL) AS invalid_timestamps,
  count(*) FILTER (message IS NULL OR trim(message) = '') AS empty_messages,
  count(*) FILTER (campaign IS NULL OR campaign = '') AS missing_campaigns, 0::BIGINT AS orphaned_users,
  count(*) FILTER (embedding IS NULL OR len(embedding) = 0 OR timestamp IS NULL OR message IS NULL OR trim(message) = ''
    OR campaign IS NULL OR campaign = '') AS affected_rows, count(*) AS total_records FROM checked)
SELECT *, round((empty_embeddings + invalid_timestamps + empty_messages + missing_campaigns) / total_records, 6)
  AS anomaly_rate FROM c""",
    "table_fingerprint": f"""WITH {WHOLE}, h AS (SELECT sha256(event_id || chr(1) || userid || chr(1)
  || coalesce(campaign, '') || chr(1) || CAST(timestamp AS VARCHAR) || chr(1) || coalesce(message, '') || chr(1)
  || '00' || CASE WHEN campaign IS NULL THEN '1' ELSE '0' END || '0' || CASE WHEN message IS NULL THEN '1' ELSE '0' END) AS h
  FROM whole)
SELECT count(*) AS row_count, CAST(sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS VARCHAR) AS content_sum FROM h""",
    "graph_nodes": f"""WITH {MSG} SELECT DISTINCT 'User' AS label, userid AS id FROM msg
UNION ALL SELECT DISTINCT 'Campaign', campaign FROM msg WHERE campaign IS NOT NULL
UNION ALL SELECT DISTINCT 'Message', message_id FROM msg""",
    "graph_edges": f"""WITH {MSG} SELECT DISTINCT 'SENT' AS label, userid AS src, message_id AS dst FROM msg
UNION ALL SELECT DISTINCT 'ABOUT', message_id, campaign FROM msg WHERE campaign IS NOT NULL""",
    "graph_merge": f"""WITH {MSG} SELECT DISTINCT 'SENT' AS label, userid AS src, message_id AS dst FROM msg""",
    "graph_edges_window": f"""WITH {MSG} SELECT DISTINCT userid AS src, message_id AS dst FROM msg
WHERE timestamp >= TIMESTAMP '2024-01-21'""",
    "user_similarity": f"""WITH {INTER}, {PAIRS} SELECT a.userid AS src, b.userid AS dst, count(*) AS weight
FROM pairs a JOIN pairs b ON a.campaign = b.campaign AND a.userid < b.userid GROUP BY ALL""",
    "similar_users_all": f"""WITH {INTER}, {PAIRS} SELECT a.userid AS user_id, b.userid AS neighbour, count(*) AS weight,
  CAST(row_number() OVER (PARTITION BY a.userid ORDER BY count(*) DESC, b.userid) AS BIGINT) AS rank
FROM pairs a JOIN pairs b ON a.campaign = b.campaign AND a.userid <> b.userid GROUP BY a.userid, b.userid QUALIFY rank <= 5""",
    "campaigns_for_user_table": f"""WITH {INTER}, {PAIRS} SELECT campaign AS campaign_id, userid,
  count(*) OVER (PARTITION BY campaign) AS user_count FROM pairs
WHERE userid IN (SELECT 'u' || c_custkey FROM customer WHERE c_acctbal > 5000)""",
    "similar_users_graph": f"""WITH {INTER}, {PAIRS} SELECT b.userid AS user_id, count(*) AS similarity
FROM pairs a JOIN pairs b ON a.campaign = b.campaign AND a.userid <> b.userid WHERE a.userid = 'u1'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "campaigns_for_users": f"""WITH {INTER}, {PAIRS} SELECT campaign AS campaign_id, count(*) AS user_count,
  string_agg(userid, ',' ORDER BY userid) AS user_list FROM pairs WHERE userid IN ('u1', 'u2', 'u3', 'u5', 'u8') GROUP BY 1""",
    "graph_user_engagement": f"""WITH {MSG}, s AS (SELECT DISTINCT userid, message_id, timestamp FROM msg),
  everyone AS (SELECT 'u' || c_custkey AS user_id FROM customer)
SELECT e.user_id, m.message_count, CASE WHEN m.message_count IS NOT NULL THEN {TIER.format(n='m.message_count')} END
  AS engagement_score, m.last_activity FROM everyone e LEFT JOIN (SELECT userid, count(*) AS message_count,
  max(epoch_us(timestamp) // 1000) AS last_activity FROM s GROUP BY userid) m ON m.userid = e.user_id""",
    "graph_integrity": f"""WITH {MSG}, everyone AS (SELECT 'u' || c_custkey AS user_id FROM customer)
SELECT 0::BIGINT AS messages_without_sender,
  (SELECT count(DISTINCT message_id) FROM msg WHERE campaign IS NULL) AS messages_without_campaign,
  (SELECT count(*) FROM everyone WHERE user_id NOT IN (SELECT userid FROM msg)) AS users_without_messages""",
    "vector_table": f"""WITH {EMB} SELECT message_id, userid AS user_id, campaign AS campaign_id, md5(message) AS message_md5,
  epoch_us(timestamp) // 1000 AS timestamp, array_to_string(list_transform(embedding, lambda x:
  CAST(round(x::DOUBLE * 1000000) AS BIGINT)), ',') AS embedding FROM emb""",
    "documents_projection": f"""WITH {MSG} SELECT m.message_id, m.userid, md5(m.message) AS message_md5,
  CAST(m.timestamp AS VARCHAR) AS timestamp, m.campaign, v.embedding IS NOT NULL AS has_embedding,
  coalesce(len(v.embedding), 0)::INT AS embedding_dim FROM msg m LEFT JOIN embeddings v ON v.vec_id = m.event_id""",
    "docs_by_user": f"""WITH {MSG} SELECT message_id, campaign, CAST(timestamp AS VARCHAR) AS timestamp, md5(message) AS message_md5
FROM msg WHERE userid = 'u1' ORDER BY timestamp DESC, message_id LIMIT 100""",
    "docs_by_campaign": f"""WITH {MSG} SELECT message_id, userid, CAST(timestamp AS VARCHAR) AS timestamp, md5(message) AS message_md5
FROM msg WHERE campaign = 'c7' ORDER BY timestamp DESC, message_id LIMIT 100""",
    "save_json_cols": f"""WITH {INTER}, {engagement('inter')} SELECT user_id, message_count, engagement_score,
  CAST(last_active AS VARCHAR) AS last_active, CASE WHEN preferred_campaigns = ''
  THEN '[]' ELSE '["' || replace(preferred_campaigns, ',', '","') || '"]' END AS preferred_campaigns FROM eng""",
    "step_throughput": f"""WITH {STEPS} SELECT seq, CASE WHEN duration_seconds > 0
  THEN round(output_count / duration_seconds, 6) ELSE 0 END AS throughput FROM steps""",
    "upsert_documents": upsert_documents_sql("""SELECT message_id, userid, processed FROM new UNION ALL
SELECT message_id, userid, processed FROM old WHERE message_id NOT IN (SELECT message_id FROM new)"""),
    "upsert_counts": upsert_documents_sql("""SELECT i.n AS inserted, t.n - i.n AS updated, t.n AS total
FROM (SELECT count(DISTINCT message_id) AS n FROM new WHERE message_id NOT IN (SELECT message_id FROM old)) i,
  (SELECT count(*) AS n FROM new) t"""),
    "upsert_campaign_freq": f"""WITH {INTER},
  hist AS (SELECT campaign AS key, count(*) AS n, count(DISTINCT userid) AS c FROM inter WHERE {HISTORY} GROUP BY 1),
  new AS (SELECT campaign AS key, count(*) AS n, count(DISTINCT userid) AS c FROM inter WHERE {ARRIVING} GROUP BY 1)
SELECT key AS campaign_id, n AS engagement_count, c AS unique_users FROM new UNION ALL
SELECT key, n, c FROM hist h WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.key IS NOT DISTINCT FROM h.key)""",
    "lineage_summary": f"""WITH {STEPS} SELECT run_id AS pipeline_run_id, count(*) AS total_steps,
  CAST(sum(input_count) AS BIGINT) AS input_records, CAST(sum(output_count) AS BIGINT) AS output_records,
  CAST(min(timestamp) AS VARCHAR) AS first_step, CAST(max(timestamp) AS VARCHAR) AS last_step FROM steps GROUP BY run_id""",
    "recent_runs": f"""WITH {RUNS} SELECT run_id, status, CAST(start_time AS VARCHAR) AS start_time, seq FROM runs
ORDER BY runs.start_time DESC, seq DESC LIMIT 20""",
    "retain_last_n": "SELECT event_id AS seq, event_type AS endpoint FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000",
    "run_summary": f"""WITH {STEPS}, {RUNS} SELECT count(*) AS total_runs,
  count(*) FILTER (status = 'completed') AS successful_runs, count(*) FILTER (status = 'failed') AS failed_runs,
  round(count(*) FILTER (status = 'completed') / count(*), 6) AS success_rate,
  round(avg(total_duration_seconds), 6) AS average_duration_seconds,
  (SELECT CAST(sum(output_count) AS BIGINT) FROM steps) AS total_records_processed FROM runs""",
    "latency_stats": latency("true"),
    "latency_recent": latency("ts >= (SELECT max(ts) FROM events) - INTERVAL 60 MINUTE"),
    "latency_anomalies": f"""WITH {STEPS},
  last10 AS (SELECT *, row_number() OVER (PARTITION BY step_name ORDER BY timestamp DESC, seq DESC) AS age FROM steps
    QUALIFY age <= 10),
  s AS (SELECT step_name, count(*) AS n, avg(duration_seconds) + 0.5 * stddev_pop(duration_seconds) AS expected_max,
    max(duration_seconds) FILTER (age = 1) AS duration FROM last10 GROUP BY 1)
SELECT step_name, round(duration, 6) AS duration, round(expected_max, 6) AS expected_max,
  round(duration - expected_max, 6) AS deviation FROM s WHERE n >= 2 AND duration > expected_max""",
    "embed_messages": f"""WITH {DOCUMENT_CELLS}
SELECT doc_id, CAST(pos AS INT) AS position, round((v / l)::FLOAT::DOUBLE, 6) AS value FROM cell JOIN norm USING (doc_id)
WHERE v <> 0""",
    "user_centroids": f"""WITH {EMB}, {CENTROIDS} SELECT userid, array_to_string(list_transform(centroid, lambda x:
  CAST(round(x * 100000) AS BIGINT)), ',') AS centroid FROM cents""",
    "knn_exact": f"""WITH g AS (SELECT a.vec_id AS qid, b.vec_id AS id, {SQL_DISTANCE.format(a='a.embedding', b='b.embedding')} AS d
  FROM embeddings a, embeddings b)
SELECT qid, id, round(d, 6) AS distance, CAST(row_number() OVER (PARTITION BY qid ORDER BY d, id) AS BIGINT) AS rank
FROM g QUALIFY rank <= 5""",
    "knn_filtered": f"""WITH g AS (SELECT a.vec_id AS qid, b.vec_id AS id, b.label, {SQL_DISTANCE.format(a='a.embedding', b='b.embedding')} AS d
  FROM embeddings a, embeddings b WHERE b.label IN (3, 7))
SELECT qid, id, round(d, 6) AS distance, CAST(row_number() OVER (PARTITION BY qid, label ORDER BY d, id) AS BIGINT) AS rank, label
FROM g QUALIFY rank <= 5""",
    "similar_users_vector": f"""WITH {EMB}, {SIMILAR} SELECT q AS user_id, u AS similar_user_id, round(s, 6) AS distance,
  round(similarity, 6) AS similarity, hits, CAST(rank AS BIGINT) AS rank FROM sim""",
    "recommendations": f"WITH {EMB}, {SCORED} SELECT {REC_COLUMNS}, {EXPLAIN} FROM recs",
    "recommendations_filtered": f"WITH {EMB}, {SCORED} SELECT {REC_COLUMNS} FROM recs WHERE 1.2 * score >= 0.7",
    "recommendations_fallback": f"""WITH {EMB}, {SCORED},
  alone AS (SELECT 'u' || c_custkey AS userid FROM customer WHERE 'u' || c_custkey NOT IN (SELECT q FROM sim)),
  top AS (SELECT campaign, n, row_number() OVER (ORDER BY n DESC, campaign) AS rank FROM freq QUALIFY rank <= 5)
SELECT {REC_COLUMNS} FROM recs UNION ALL
SELECT userid, campaign, round(0.5 * n / (SELECT max(n) FROM top), 6), round(0.6 * n / (SELECT max(n) FROM top), 6),
  CAST(rank AS BIGINT), 0.0, 0, round(n / (SELECT max(n) FROM top), 6), '' FROM alone, top""",
    "stream_daily_counts": f"""WITH {INTER} SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS activity_date,
  campaign AS campaign_id, count(*) AS message_count, CAST(max(timestamp) AS VARCHAR) AS last_message FROM inter GROUP BY ALL""",
}

# the same answers by another way: every cell probed, and what a search of few cells still finds
SQL["knn_ivf_all_cells"] = SQL["knn_exact"]
SQL["recommendations_ivf_all_cells"] = SQL["recommendations"]
SQL["knn_growing"] = SQL["stream_index"] = SQL["knn_exact"]
SQL["knn_ivf_recall"] = """SELECT 5 AS k, 5 * count(*) AS expected, true AS enough FROM embeddings
UNION ALL SELECT 50, 50 * count(*), true FROM embeddings"""

# times lose their fraction where events go through text
TEXT = WHOLE + """, text_msg AS (
  SELECT event_id, userid, campaign, date_trunc('second', timestamp) AS timestamp, message,
    sha256(userid || '|' || coalesce(campaign, 'None') || '|' || CAST(date_trunc('second', timestamp) AS VARCHAR) || '|'
      || coalesce(message, 'None')) AS message_id
  FROM whole)"""

DIGEST = "userid, campaign, CAST(timestamp AS VARCHAR) AS timestamp, md5(message) AS message_md5"

SQL["events_from_json_lines"] = f"WITH {TEXT} SELECT {DIGEST} FROM text_msg"
SQL["events_with_rejects"] = f"""WITH {INTER} SELECT CASE WHEN userid LIKE '%5' THEN 'bad timestamp' ELSE 'good' END AS reason,
  userid, count(*) AS n FROM inter GROUP BY ALL"""
SQL["raw_events_by_day"] = f"WITH {WHOLE} SELECT {DIGEST} FROM whole"
SQL["embeddings_stored"] = f"""WITH {EMB} SELECT event_id, array_to_string(list_transform(embedding, lambda x:
  CAST(round(x::DOUBLE * 1000000) AS BIGINT)), ',') AS embedding FROM emb"""
SQL["csv_export"] = SQL["save_json_cols"]
SQL["document_store"] = f"""WITH {MSG},
  old AS (SELECT DISTINCT message_id FROM msg WHERE {HISTORY}),
  new AS (SELECT message_id FROM msg WHERE {ARRIVING}),
  did AS (SELECT count(DISTINCT message_id) FILTER (message_id NOT IN (SELECT message_id FROM old)) AS inserted, count(*) AS total
    FROM new)
SELECT DISTINCT message_id, userid, md5(message) AS message_md5, (SELECT inserted FROM did) AS inserted,
  (SELECT total - inserted FROM did) AS updated FROM msg"""
SQL["stream_documents"] = f"WITH {TEXT} SELECT DISTINCT message_id, userid, md5(message) AS message_md5 FROM text_msg"
SQL["stream_embeddings"] = f"""WITH {TEXT}, {DOCUMENT_CELLS}, {DOCUMENT_VECTORS}
SELECT DISTINCT t.message_id, array_to_string(list_transform(v.embedding, lambda x:
  CAST(round(x::DOUBLE * 100000) AS BIGINT)), ',') AS embedding
FROM text_msg t JOIN vec v ON v.doc_id = t.event_id % (SELECT count(*) FROM documents)"""

SQL["latency_sketched"] = """SELECT event_type AS endpoint, count(*) AS count, round(avg(value / 1000 * 1000), 6) AS avg_latency_ms,
  true AS p50_latency_ms_near, true AS p95_latency_ms_near, true AS p99_latency_ms_near FROM events GROUP BY 1"""
SQL["stream_distinct_users"] = f"""WITH {INTER}, d AS (SELECT *, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day FROM inter)
SELECT 'both' AS by, day AS activity_date, campaign AS campaign_id, count(*) AS message_count, count(DISTINCT userid) AS unique_users
FROM d GROUP BY day, campaign
UNION ALL SELECT 'day', day, NULL, count(*), count(DISTINCT userid) FROM d GROUP BY day
UNION ALL SELECT 'campaign', NULL, campaign, count(*), count(DISTINCT userid) FROM d GROUP BY campaign"""

METRIC_TALLIES = """SELECT 'user_engagement' AS "table", userid AS key, count(*) AS n FROM {t} GROUP BY userid
UNION ALL SELECT 'campaign_performance', campaign, count(*) FROM {t} GROUP BY campaign
UNION ALL SELECT 'user_activity_daily', CAST(timestamp AS DATE) || ' ' || userid, count(*) FROM {t} GROUP BY 2"""
REPORT_TALLY = "UNION ALL SELECT 'report', 'total_messages', count(*) FROM {t}"

SQL["created_tables"] = f"""WITH {INTER} {METRIC_TALLIES.format(t='inter')}
UNION ALL SELECT 'campaign_engagement_frequency', campaign, count(DISTINCT userid) FROM inter GROUP BY campaign"""
SQL["metrics_job_tables"] = f"WITH {INTER} {METRIC_TALLIES.format(t='inter')} {REPORT_TALLY.format(t='inter')}"
# the pipeline keeps each event once, with its message cut
SQL["whole_run_tables"] = f"""WITH {WHOLE}, kept AS (SELECT DISTINCT userid, campaign, date_trunc('second', timestamp) AS timestamp,
    substr(message, 1, 1000) AS message, message AS whole_message FROM whole WHERE message IS NOT NULL),
  sent AS (SELECT DISTINCT userid, campaign, timestamp, message FROM kept)
{METRIC_TALLIES.format(t='kept')} {REPORT_TALLY.format(t='kept')}
UNION ALL SELECT 'documents', userid, count(*) FROM sent GROUP BY userid
UNION ALL SELECT 'vectors', userid, count(*) FROM kept GROUP BY userid
UNION ALL SELECT 'graph/sent', userid, count(*) FROM sent GROUP BY userid
UNION ALL SELECT 'graph/about', campaign, count(*) FROM sent WHERE campaign IS NOT NULL GROUP BY campaign
UNION ALL SELECT 'step_metrics', s, 1 FROM (SELECT unnest(['ingestion', 'document_storage', 'embedding_generation', 'vector_storage',
  'graph_build', 'analytics_aggregation']) AS s)
UNION ALL SELECT 'frequency', campaign, count(DISTINCT userid) FROM kept GROUP BY campaign"""
SQL["similarity_rolling"] = f"""WITH {INTER}, near AS (SELECT DISTINCT userid, campaign FROM inter
  WHERE campaign IS NOT NULL AND CAST(timestamp AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-26')
SELECT a.userid AS src, b.userid AS dst, count(*) AS weight FROM near a JOIN near b ON a.campaign = b.campaign AND a.userid < b.userid GROUP BY ALL"""
