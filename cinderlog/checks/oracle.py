"""The same queries as plain SQL over the given tables. Nothing here is shared with the
Spark code but the text of the log lines; templates and parameters are written out by
kind of event, so that mining is checked against how the lines were made."""

from cinderlog.checks.loglines import CONTENT, LEVEL, RETRY_TEMPLATE, SLOW_TEMPLATE, TRANSFER_TEMPLATE

_TEMPLATE = f"""CASE event_type
  WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'IOException in offerService'
    ELSE 'PacketResponder for <*> and <*> terminating' END
  WHEN 'purchase' THEN '{SLOW_TEMPLATE}'
  WHEN 'signup' THEN '{RETRY_TEMPLATE}'
  WHEN 'click' THEN 'Receiving block <*> src: <*> dest: <*>'
  ELSE '{TRANSFER_TEMPLATE}' END"""

_PARAMETERS = """CASE event_type
  WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN ''
    ELSE 'blk_' || user_id || '|blk_-' || user_id END
  WHEN 'purchase' THEN 'cost:' || CAST(floor(value*100) AS BIGINT) || 'ms'
  WHEN 'signup' THEN '/10.0.0.' || (user_id % 8) || ':9000|' || (event_id % 10)
  WHEN 'click' THEN 'blk_' || user_id || '|/10.0.1.' || (user_id % 16) || ':50010|/10.0.2.'
    || (event_id % 16) || ':50011'
  ELSE '/10.0.1.' || (user_id % 16) || ':50010|/10.0.2.' || (event_id % 16) || ':50010|'
    || ((event_id % 64 + 1) * 1048576) || ',|BP-1-10.0.0.1-2:blk_' || user_id || '_1,|'
    || (CAST(floor(value*1000000) AS BIGINT) + 1) END"""

_LOGS = f"""lines AS (
  SELECT event_id AS line_id, strftime(ts, '%y%m%d') AS log_date, strftime(ts, '%H%M%S') AS log_time,
    CAST(user_id AS VARCHAR) AS pid, {LEVEL} AS log_level, 'dfs.DataNode' AS component,
    {CONTENT} AS content, date_trunc('second', ts) AS event_time,
    {_TEMPLATE} AS event_template, {_PARAMETERS} AS parameters
  FROM events),
logs AS (SELECT *, left(md5(event_template), 8) AS event_id FROM lines)"""

_BLOCKS = f"""{_LOGS}, blocks AS (
  SELECT unnest(list_distinct(regexp_extract_all(content, '(blk_-?[0-9]+)', 1))) AS block_id,
    event_time, line_id, event_id FROM logs),
heads AS (
  SELECT block_id, min(event_time) AS first_time, count(*) AS n_events FROM blocks GROUP BY 1),
labelled AS (
  SELECT h.*, coalesce(CAST(l.toxic = 1 AS INTEGER), 0) AS label
  FROM heads h LEFT JOIN labels l ON h.block_id = 'blk_' || l.doc_id),
stratified AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(block_id), block_id)
    <= floor(count(*) OVER (PARTITION BY label) * CAST(0.8 AS DOUBLE)) AS is_train FROM labelled),
sequential AS (
  SELECT *, row_number() OVER (ORDER BY first_time, block_id)
    <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS is_train FROM labelled)"""

_LEARNED = f"""{_BLOCKS}, served AS (
  SELECT DISTINCT unnest(regexp_extract_all(content, '(blk_-?[0-9]+)', 1)) AS block_id
  FROM logs WHERE content LIKE 'Receiving block%' OR content LIKE 'src: %'),
truth AS (SELECT block_id, CAST(block_id NOT IN (SELECT block_id FROM served) AS INTEGER) AS label FROM heads),
tested AS (
  SELECT label, count(*) - CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n FROM truth GROUP BY 1)"""

_COUNTS = f"""{_LOGS}, counts AS (
  SELECT date_trunc('minute', event_time) AS window_start,
    date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, log_level,
    count(*) AS event_count,
    first(event_time ORDER BY event_time, line_id) AS orig_first_timestamp,
    last(event_time ORDER BY event_time, line_id) AS orig_last_timestamp
  FROM logs GROUP BY 1, 2, 3)"""

_RUNS = """sums AS (
  SELECT CAST(event_id // 500 AS VARCHAR) AS batch_id, count(*) AS record_count,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100000.0 AS latency,
    CAST(epoch(date_trunc('second', min(ts))) AS DOUBLE) AS "timestamp"
  FROM events GROUP BY 1),
runs AS (
  SELECT *, CASE WHEN latency > 0 THEN floor(record_count / latency * 1000.0) / 1000.0 ELSE 0.0 END
    AS throughput FROM sums)"""

_TERMS = """words AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS term FROM documents),
terms AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term <> '' GROUP BY 1, 2),
idf AS (
  SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf
  FROM terms GROUP BY 1),
weighted AS (SELECT doc_id, term, tf, tf * idf AS tfidf FROM terms JOIN idf USING (term))"""

_HEADER = "log_date, log_time, pid, log_level, component, content"


def _text(column, name=None):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


_COUNT_COLUMNS = ", ".join(
    [_text("window_start"), _text("window_end"), "log_level", "event_count",
     _text("orig_first_timestamp"), _text("orig_last_timestamp")]
)

_MONTHLY = f"""WITH {_LOGS} SELECT log_level, strftime(event_time, '%Y%m') AS month,
  count(event_id) AS total_records, count(DISTINCT event_id) AS distinct_eventid
  FROM logs GROUP BY 1, 2"""

_RETRY = f"""WITH {_LOGS} SELECT CAST(regexp_extract(content, 'Already tried ([0-9]+)', 1) AS INTEGER)
  AS retrycount, count(*) AS event_count FROM logs WHERE event_template = '{RETRY_TEMPLATE}' GROUP BY 1"""

# Groups of line shapes are split, all at once per round, until each is one template.
_DOCUMENT_TEMPLATES = """WITH RECURSIVE lines AS (SELECT list_transform(string_split(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' '),
      lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)),
  shapes AS (SELECT t, count(*) AS n FROM lines GROUP BY t),
  work(t, grp, round) AS (
    SELECT t, len(t) || ' ' || array_to_string(t[1:2], ' '), 0 FROM shapes
    UNION ALL
    SELECT t, md5(grp || ' ' || cut || ' ' || t[cut]), round + 1 FROM (
      SELECT w.*, g.cut[2] AS cut FROM work w JOIN (
        SELECT grp, min([kinds, pos]) FILTER (kinds > 1) AS cut,
          2 * count(*) FILTER (kinds = 1 AND word <> '<*>') >= count(*) AS similar
        FROM (SELECT grp, pos, count(DISTINCT word) AS kinds, min(word) AS word
          FROM (SELECT grp, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS pos FROM work) GROUP BY ALL)
        GROUP BY grp) g ON w.grp = g.grp WHERE g.cut IS NOT NULL AND NOT g.similar)),
  last AS (SELECT t, max_by(grp, round) AS grp FROM work GROUP BY t),
  named AS (SELECT grp, string_agg(CASE WHEN kinds = 1 THEN word ELSE '<*>' END, ' ' ORDER BY pos) AS template
    FROM (SELECT grp, pos, count(DISTINCT word) AS kinds, min(word) AS word
      FROM (SELECT grp, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS pos FROM last) GROUP BY ALL) GROUP BY grp)
  SELECT template, count(*) AS n_patterns, sum(n)::BIGINT AS n_lines, min(array_to_string(t, ' ')) AS first_pattern
  FROM shapes JOIN last USING (t) JOIN named USING (grp) GROUP BY template"""

_TEMPLATE_COUNTS = f"""WITH {_LOGS} SELECT event_id, event_template, count(*) AS event_count
  FROM logs GROUP BY 1, 2"""

_COUNT_POINTS = f"""WITH {_COUNTS} SELECT 'metrics,level=' || log_level || ' event_count=' || event_count || 'i '
  || (epoch_us(window_end) * 1000) AS value FROM counts"""

_MASKED = r"""regexp_replace(regexp_replace(content, 'BP-\d+-\d+\.\d+\.\d+\.\d+-\d+', '<*>', 'g'),
  '(/|)([0-9]+\.){3}[0-9]+(:[0-9]+|)(:|)', '<*>', 'g')"""

_PARTS = """placed AS (
  SELECT *, (row_number() OVER (PARTITION BY block_id ORDER BY event_time, line_id) - 1) // 5 AS part FROM blocks),
parts AS (SELECT block_id, part, count(*) AS own_events,
  string_agg(event_id, ',' ORDER BY event_time, line_id) AS event_sequence FROM placed GROUP BY 1, 2)"""

_SEQUENCES = """SELECT block_id, string_agg(event_id, ',' ORDER BY event_time, line_id) AS event_sequence
  FROM blocks GROUP BY 1"""

ORACLE = {
    "header_parse": f"WITH {_LOGS} SELECT line_id, {_HEADER} FROM logs",
    "text_log_scan": f"WITH {_LOGS} SELECT {_HEADER} FROM logs",
    "rejected_lines": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (
        NOT regexp_matches(line, '^\S+\s+[^,\s]+,\S+\s+\S+\s+(\S|\S.*?\S):\s+')) AS n_rejected
      FROM l GROUP BY 1""",
    "event_timestamp": f"""SELECT event_id AS line_id, {_text("date_trunc('second', ts)", "event_time")},
      strftime(ts, '%Y%m') AS month FROM events""",
    "log_templates": f"""WITH {_LOGS} SELECT event_id, event_template, count(*) AS n_lines,
      min(line_id) AS first_line FROM logs GROUP BY 1, 2""",
    "structured_lines": f"""WITH {_LOGS} SELECT line_id, {_HEADER}, {_text("event_time")}, event_id,
      event_template, parameters FROM logs""",
    "document_templates": _DOCUMENT_TEMPLATES,
    "template_topk": f"{_TEMPLATE_COUNTS} ORDER BY event_count DESC, event_id LIMIT 3",
    "skeleton_topk": f"""WITH {_LOGS} SELECT {_MASKED} AS skeleton, count(*) AS n_lines FROM logs
      GROUP BY 1 ORDER BY n_lines DESC, skeleton LIMIT 50""",
    "document_skeletons": """WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
      SELECT regexp_replace(line, '[0-9]+', '<*>', 'g') AS skeleton, count(*) AS n_lines FROM l GROUP BY 1""",
    "severity_report": f"""WITH {_LOGS} SELECT count(*) FILTER (log_level = 'ERROR') AS error,
      count(*) FILTER (log_level = 'WARN') AS warn, count(*) FILTER (log_level = 'INFO') AS info,
      count(*) FILTER (log_level = 'FATAL') AS fatal FROM logs""",
    "exceptions_report": f"""WITH {_LOGS} SELECT log_date, count(*) AS event_count FROM logs
      WHERE content = 'IOException in offerService' GROUP BY 1""",
    "write_latency_report": f"""WITH {_LOGS} SELECT round(avg(CAST(regexp_extract(content, '([0-9]+)', 1) AS INTEGER)), 6)
      AS average_write_latency FROM logs WHERE content LIKE 'Slow BlockReceiver%'""",
    "transfer_speed_report": f"""WITH {_LOGS}, t AS (SELECT line_id,
        regexp_extract(content, 'src: /([^ ,]+)', 1) AS src, regexp_extract(content, 'dest: /([^ ,]+)', 1) AS dest,
        (CAST(regexp_extract(content, 'bytes: ([0-9]+)', 1) AS BIGINT) / 1048576.0::DOUBLE)
        / (CAST(regexp_extract(content, 'duration: ([0-9]+)', 1) AS BIGINT) / 1e9::DOUBLE) AS rate
      FROM logs WHERE content LIKE 'src: %')
      SELECT line_id, src, dest, format('{{:,.2f}}', rate) AS speed, round(rate, 6) AS speed_mib_s FROM t""",
    "retry_report": _RETRY,
    "retry_report_by_parameter": _RETRY,
    "monthly_severity_report": _MONTHLY,
    "report_files": _MONTHLY,
    "line_identity": "SELECT count(*) AS n_lines, count(*) AS n_ids, count(*) AS n_equal FROM events",
    "report_set": f"""WITH {_LOGS}, t AS (SELECT
        (CAST(regexp_extract(content, 'bytes: ([0-9]+)', 1) AS BIGINT) / 1048576.0::DOUBLE)
        / (CAST(regexp_extract(content, 'duration: ([0-9]+)', 1) AS BIGINT) / 1e9::DOUBLE) AS rate
      FROM logs WHERE content LIKE 'src: %')
      SELECT 'exceptions' AS report, log_date AS key, count(*)::DOUBLE AS number FROM logs
        WHERE content = 'IOException in offerService' GROUP BY 2
      UNION ALL SELECT 'severity', lower(log_level), count(*) FROM logs GROUP BY 2
      UNION ALL SELECT 'slowness', 'average', round(avg(CAST(regexp_extract(content, '([0-9]+)', 1) AS INTEGER)), 6)
        FROM logs WHERE content LIKE 'Slow BlockReceiver%'
      UNION ALL SELECT 'speed', 'lines', count(*) FROM t
      UNION ALL SELECT 'speed', 'sum', round(sum(rate), 2) FROM t
      UNION ALL SELECT 'retrycount', regexp_extract(content, 'Already tried ([0-9]+)', 1), count(*) FROM logs
        WHERE event_template = '{RETRY_TEMPLATE}' GROUP BY 2
      UNION ALL SELECT 'monthly', log_level || ' ' || strftime(event_time, '%Y%m'), count(*) FROM logs GROUP BY 2""",
    "structured_csv": f"""WITH {_LOGS} SELECT line_id, log_level, content, event_id, {_text("event_time")},
      parameters FROM logs""",
    "block_endpoints": f"""WITH {_LOGS}, e AS (SELECT line_id,
        regexp_extract(content, '(blk_-?[0-9]+)', 1) AS first_block_id,
        regexp_extract(content, 'src: /([^ ]+)', 1) AS source,
        regexp_extract(content, 'dest: /([^ ]+)', 1) AS destination FROM logs)
      SELECT *, regexp_extract(source, '([^:]+)', 1) AS source_ip,
        TRY_CAST(regexp_extract(source, '([^:]+):([0-9]+)', 2) AS INTEGER) AS source_port,
        regexp_extract(destination, '([^:]+)', 1) AS destination_ip,
        TRY_CAST(regexp_extract(destination, '([^:]+):([0-9]+)', 2) AS INTEGER) AS destination_port FROM e""",
    "block_events": f"WITH {_BLOCKS} SELECT block_id, line_id, event_id, {_text('event_time')} FROM blocks",
    "block_sessions": f"WITH {_BLOCKS}, {_PARTS} SELECT * FROM parts",
    "labelled_sessions": f"""WITH {_BLOCKS}, {_PARTS}
      SELECT block_id, part, label, event_sequence FROM parts JOIN labelled USING (block_id)""",
    "split_sequential": f"WITH {_BLOCKS} SELECT block_id, CAST(is_train AS INTEGER) AS is_train FROM sequential",
    "split_stratified": f"""WITH {_BLOCKS} SELECT block_id, label, CAST(is_train AS INTEGER) AS is_train
      FROM stratified""",
    "split_complement": f"""WITH {_BLOCKS}, p AS (
        SELECT unnest(CASE WHEN is_train THEN ['train', 'union'] ELSE ['test', 'difference', 'anti', 'union'] END)
          AS part, label FROM stratified)
      SELECT part, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_anomalous FROM p GROUP BY 1""",
    "session_head": f"""WITH {_BLOCKS} SELECT block_id, {_text('first_time')}, n_events, label FROM labelled
      ORDER BY labelled.first_time, block_id LIMIT 100""",
    "shuffled_sessions": f"""WITH {_BLOCKS} SELECT block_id, label,
      row_number() OVER (ORDER BY md5(block_id || '#7'), block_id) AS position FROM labelled""",
    "sequence_slices": f"""WITH {_BLOCKS}, s AS (
        SELECT block_id, list(event_id ORDER BY event_time, line_id) AS seq FROM blocks GROUP BY 1),
      i AS (SELECT block_id, seq, unnest(range(0, len(seq) - 2)) AS start FROM s)
      SELECT block_id, start // 5 AS part, label, CAST(is_train AS INTEGER) AS is_train, start,
        array_to_string(seq[start + 1 : start + 3], ',') AS event_sequence,
        coalesce(seq[start + 4], '#Pad') AS next_event FROM i JOIN sequential USING (block_id)""",
    "level_counts_1m": f"WITH {_COUNTS} SELECT {_COUNT_COLUMNS} FROM counts",
    "stream_level_counts": f"WITH {_COUNTS} SELECT {_COUNT_COLUMNS} FROM counts",
    "stream_archive": f"WITH {_LOGS} SELECT line_id, {_HEADER}, event_id, parameters FROM logs",
    "replay_stream": f"WITH {_LOGS} SELECT {_HEADER} FROM logs",
    "stream_templates": _TEMPLATE_COUNTS,
    "stream_line_ids": """SELECT count(*) AS n_lines, count(*) AS n_ids, 0::BIGINT AS first_id,
      count(*) - 1 AS last_id FROM events""",
    "stream_side_counts": f"WITH {_LOGS} SELECT log_level, count(*) AS event_count FROM logs GROUP BY 1",
    "stream_batch_points": """SELECT measure, 3::BIGINT AS n_batches, 2::BIGINT AS last_batch, count(*) AS lines
      FROM events, (VALUES ('record_count'), ('latency x throughput')) m(measure) GROUP BY 1""",
    "stream_points": _COUNT_POINTS,
    "latest_per_level": f"""WITH {_COUNTS} SELECT log_level, {_text("max(window_end)", "window_end")},
      arg_max(event_count, counts.window_end) AS event_count FROM counts GROUP BY 1""",
    "count_trend": f"""WITH {_COUNTS} SELECT log_level, {_text("window_end")}, event_count FROM counts
      WHERE counts.window_end >= (SELECT max(c.window_end) FROM counts c) - INTERVAL 7 DAYS
        AND counts.window_end <= (SELECT max(c.window_end) FROM counts c)""",
    "mean_per_interval": f"""WITH {_RUNS}, b AS (
        SELECT CAST(floor("timestamp" / 900) AS BIGINT) * 900 AS bucket, avg(latency) AS l, avg(throughput) AS t,
          avg(record_count) AS r FROM runs GROUP BY 1),
      axis AS (SELECT unnest(range(min(bucket), max(bucket) + 900, 900)) AS bucket FROM b)
      SELECT {_text("to_timestamp(bucket) AT TIME ZONE 'UTC'", "interval_start")}, round(l, 6) AS mean_latency,
        round(t, 6) AS mean_throughput, round(r, 6) AS mean_record_count
      FROM axis LEFT JOIN b USING (bucket)""",
    "message_instants": f"""WITH {_COUNTS}, {_RUNS}, t AS (
        SELECT DISTINCT 'window_end' AS kind, window_end AS instant FROM counts
        UNION ALL SELECT 'timestamp', to_timestamp("timestamp") AT TIME ZONE 'UTC' FROM runs)
      SELECT kind, {_text("instant", "time")} FROM t""",
    "stream_batch_metrics": "SELECT count(*) AS record_count FROM events",
    "points_counts": _COUNT_POINTS,
    "points_metrics": f"""WITH {_RUNS} SELECT 'streaming_metrics,batch_id=' || batch_id || ' latency=' || latency
      || ',record_count=' || record_count || 'i,throughput=' || throughput || ' '
      || (CAST("timestamp" AS BIGINT) * 1000000000) AS value FROM runs""",
    "json_roundtrip": f"""WITH {_LOGS} SELECT line_id, log_level, content, {_text("event_time")}, parameters
      FROM logs""",
    "parameter_items": f"""WITH {_LOGS}, i AS (
        SELECT line_id, list_transform(string_split(parameters, '|'),
          lambda p: regexp_replace(replace(p, '/', ''), ',$', '')) AS items FROM logs)
      SELECT line_id, len(items) AS n_items, items[1] AS first_item, items[2] AS second_item,
        TRY_CAST(regexp_extract(array_to_string(items, ' '), '[0-9]+') AS INTEGER) AS first_integer FROM i""",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "term_frequency": f"WITH {_TERMS} SELECT doc_id, term, tf FROM terms",
    "idf_weights": f"WITH {_TERMS} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "tfidf": f"WITH {_TERMS} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM weighted",
    "tfidf_centered": f"""WITH {_TERMS}, m AS (
        SELECT term, sum(tfidf) / (SELECT count(*) FROM documents) AS mean FROM weighted GROUP BY 1)
      SELECT doc_id, term, round(tfidf - mean, 6) + 0.0 AS centred, round(-mean, 6) + 0.0 AS baseline
      FROM weighted JOIN m USING (term)""",
    "tfidf_ratio": f"WITH {_TERMS} SELECT doc_id, term, round(tfidf / (1 + tfidf), 6) AS ratio FROM weighted",
    "session_tfidf": f"""WITH {_BLOCKS}, c AS (
        SELECT block_id, event_id, count(*) AS tf FROM blocks GROUP BY 1, 2),
      i AS (SELECT event_id, ln(((SELECT count(*) FROM heads) + 1) / (count(*) + 1)) AS idf FROM c GROUP BY 1)
      SELECT block_id, event_id, tf, round(tf * idf, 6) AS tfidf FROM c JOIN i USING (event_id)""",
    "confusion_metrics": """WITH c AS (SELECT count(*) FILTER (toxic = 1 AND quality = 0) AS tp,
        count(*) FILTER (toxic = 0 AND quality = 0) AS fp, count(*) FILTER (toxic = 0 AND quality = 1) AS tn,
        count(*) FILTER (toxic = 1 AND quality = 1) AS fn FROM labels),
      r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c)
      SELECT tp, fp, tn, fn, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(p, 6) AS "precision",
        round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM r""",
    "roc_auc": """WITH s AS (SELECT n_chars, toxic, rank() OVER (ORDER BY n_chars)
          + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r
        FROM labels JOIN documents USING (doc_id)),
      a AS (SELECT sum(r) FILTER (toxic = 1) AS rs, count(*) FILTER (toxic = 1) AS p,
        count(*) FILTER (toxic = 0) AS n FROM s)
      SELECT round((rs - p * (p + 1) / 2) / (p * n), 6) AS roc_auc FROM a""",
    "anomaly_summary": f"WITH {_BLOCKS} SELECT count(*) AS block_ids_count FROM heads",
    # The labels follow from the log, so that a model trained on them gives them back for every block.
    "anomaly_learned_metrics": f"""WITH {_LEARNED}, c AS (
        SELECT sum(n) FILTER (label = 1)::BIGINT AS tp, sum(n) FILTER (label = 0)::BIGINT AS tn FROM tested)
      SELECT features, tp, 0::BIGINT AS fp, tn, 0::BIGINT AS fn, 1::DOUBLE AS accuracy, 1::DOUBLE AS "precision",
        1::DOUBLE AS recall, 1::DOUBLE AS f1, 1::DOUBLE AS roc_auc
      FROM c, (VALUES ('tf-idf, None'), ('tf-idf, ratio'), ('tf-idf, zero-mean'), ('None, None'),
        ('None, zero-mean')) v(features)""",
    "anomaly_learned_predictions": f"""WITH {_LEARNED}
      SELECT block_id, label AS prediction, label AS over_margin FROM truth""",
    "anomaly_learned_summary": f"""WITH {_LEARNED}
      SELECT sum(label)::BIGINT AS anomaly_count, count(*) AS block_ids_count FROM truth""",
    "train_test_export": f"""WITH {_BLOCKS}, s AS ({_SEQUENCES})
      SELECT block_id, label, CAST(is_train AS INTEGER) AS is_train, event_sequence
      FROM s JOIN sequential USING (block_id)""",
}
