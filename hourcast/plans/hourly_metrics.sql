-- Hourly metrics of the listed accounts in the listed months (year * 100 + month).
-- {signalling}: account, ts, op, year, month
-- {sessions}:   account, ts, code, rectype, subscriber, year, month
-- {accounts}:   account
WITH op_counts AS (
  SELECT account, ts :: date :: timestamp_ntz + hour(ts) * INTERVAL '1' HOUR AS hour, op, count(*) AS n
  FROM {signalling}
  WHERE op IS NOT NULL
    AND array_contains(:months, year * 100 + month)
    AND account IN (SELECT account FROM {accounts})
  GROUP BY account, 2, op
),
op_rollup AS (
  SELECT account, hour, op, grouping(op) AS is_total, sum(n) AS value
  FROM op_counts
  GROUP BY account, hour, ROLLUP (op)
),
signalling_metrics AS (
  SELECT account, hour, if(is_total = 1, :total_metric, try_element_at(:opcodes, op)) AS metric, value
  FROM op_rollup
),
session_hours AS (
  SELECT account, ts :: date :: timestamp_ntz + hour(ts) * INTERVAL '1' HOUR AS hour,
         count_if(code = 128 AND rectype = 1) AS created,
         count_if(code = 128 AND rectype = 2) AS deleted,
         count(DISTINCT subscriber) AS subscribers
  FROM {sessions}
  WHERE array_contains(:months, year * 100 + month)
    AND account IN (SELECT account FROM {accounts})
  GROUP BY account, 2
),
session_metrics AS (
  SELECT account, hour,
         stack(3, 'createPdpCountV1', created, 'deletePdpCountV1', deleted, 'imsiSum', subscribers)
           AS (metric, value)
  FROM session_hours
)
SELECT account, hour, extract(DAYOFWEEK_ISO FROM hour) AS day_of_week, metric, value
FROM (
  SELECT * FROM signalling_metrics WHERE metric IS NOT NULL
  UNION ALL
  SELECT * FROM session_metrics
)
ORDER BY hour, account, metric
