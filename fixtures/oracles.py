"""DuckDB texts that give what the queries give."""

from __future__ import annotations

import numpy as np

from fixtures.settings import (
    ACCOUNT_SHIFT,
    DEAR,
    GRID,
    HORIZON,
    LAGS,
    SMALL_NET,
    SPOT,
    TINY_NET,
    TRAIN,
    VALID,
    given_weights,
)
from hourcast.config import METRIC_IDS
from hourcast.functions.network import shapes

_SIGNALLING = """
signalling AS (
  SELECT CAST(user_id AS VARCHAR) AS account, ts, event_type AS op FROM events
)"""

_SESSIONS = """
sessions AS (
  SELECT CAST(user_id AS VARCHAR) AS account, ts,
         CASE WHEN value >= 50 THEN 128 ELSE 0 END AS code,
         CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS rectype,
         json_extract_string(props, '$.k') AS subscriber
  FROM events
)"""

_METRIC_OF_OP = """CASE op WHEN 'click' THEN 'countSAI' WHEN 'view' THEN 'countUL'
    WHEN 'purchase' THEN 'countUGL' WHEN 'signup' THEN 'countCL' END"""


def _opcode_counts(source: str = "signalling") -> str:
    return f"""
opcode_counts AS (
  SELECT * FROM (
    SELECT account, date_trunc('hour', ts) AS hour, {_METRIC_OF_OP} AS metric, count(*) AS value
    FROM {source} WHERE op IS NOT NULL GROUP BY 1, 2, 3
  ) WHERE metric IS NOT NULL
  UNION ALL
  SELECT account, date_trunc('hour', ts), 'mapsum', count(*)
  FROM {source} WHERE op IS NOT NULL GROUP BY 1, 2
)"""


def _conditional_counts(source: str = "sessions") -> str:
    branches = [
        f"""SELECT account, date_trunc('hour', ts) AS hour, '{metric}' AS metric,
         CAST(sum(CASE WHEN code = 128 AND rectype = {rectype} THEN 1 ELSE 0 END) AS BIGINT) AS value
  FROM {source} GROUP BY 1, 2"""
        for metric, rectype in (("createPdpCountV1", 1), ("deletePdpCountV1", 2))
    ]
    return "\nconditional_counts AS (\n  " + "\n  UNION ALL\n  ".join(branches) + "\n)"


def _subscribers(source: str = "sessions") -> str:
    return f"""
subscribers AS (
  SELECT account, date_trunc('hour', ts) AS hour, 'imsiSum' AS metric,
         count(DISTINCT subscriber) AS value
  FROM {source} GROUP BY 1, 2
)"""


def _hourly_sql(signalling: str = "signalling", sessions: str = "sessions") -> str:
    return f"""{_opcode_counts(signalling)},{_conditional_counts(sessions)},{_subscribers(sessions)},
hourly AS (
  SELECT account, hour, CAST(isodow(hour) AS INTEGER) AS day_of_week, metric, value
  FROM (SELECT * FROM opcode_counts UNION ALL SELECT * FROM conditional_counts
        UNION ALL SELECT * FROM subscribers)
)"""


_ACCOUNTS = """
accounts AS (
  SELECT account, CAST(row_number() OVER (ORDER BY account) - 1 AS INTEGER) AS account_int
  FROM (SELECT DISTINCT account FROM signalling)
)"""

_METRICS = (
    "\nmetric_ids(metric, metric_int) AS (VALUES "
    + ", ".join(f"('{name}', {number})" for name, number in METRIC_IDS.items())
    + ")"
)

_TOP = """
top AS (
  SELECT account, count(*) AS n_events FROM signalling GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100
)"""

_GRID = f"""
grid AS (
  SELECT account, account_int, metric, metric_int, hour
  FROM accounts, metric_ids,
       generate_series(TIMESTAMP '{GRID[0]}', TIMESTAMP '{GRID[1]}' - INTERVAL 1 HOUR,
                       INTERVAL 1 HOUR) AS hours(hour)
)"""

_DENSE = """
dense AS (
  SELECT account_int, metric_int, hour,
         CASE WHEN coalesce(value, 0) = 0 THEN CAST(1.1920928955078125e-07 AS DOUBLE)
              ELSE CAST(value AS DOUBLE) END AS value,
         CAST(isodow(hour) - 1 AS INTEGER) AS dayofweek
  FROM grid LEFT JOIN hourly USING (account, metric, hour)
)"""

_HOURLY = f"WITH {_SIGNALLING},{_SESSIONS},{_hourly_sql()}"
_SERIES = f"{_HOURLY},{_ACCOUNTS},{_METRICS},{_GRID},{_DENSE}"

_N_WINDOWS = 720 - LAGS - HORIZON + 1

# Every forecast cell of the day-before forecast: window starts differ, hours
# and values repeat.
_CELLS = f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY account_int, metric_int ORDER BY hour) - 1 AS i
  FROM dense
),
cells AS (
  SELECT t.account_int, t.metric_int, t.value AS y, f.value AS yhat
  FROM numbered t JOIN numbered f
    ON t.account_int = f.account_int AND t.metric_int = f.metric_int AND f.i = t.i - {HORIZON}
  CROSS JOIN range(0, {HORIZON}) AS steps(step)
  WHERE t.i - {LAGS} - step BETWEEN 0 AND {_N_WINDOWS - 1}
)"""

_SMAPE = (
    "round(200 * sum(abs(y - yhat) / greatest(abs(y) + abs(yhat), 1e-8)) / count(*), 6) AS smape,"
    " count(*) AS n"
)


_TOPK = """
WITH pairs AS (
  SELECT a.vec_id AS id, b.vec_id AS neighbour,
         round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9)
           AS cosine
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, neighbour) AS rank FROM pairs
)
SELECT id, CAST(rank AS INTEGER) AS rank, neighbour, round(cosine, 6) AS cosine
FROM ranked WHERE rank <= 3"""

_NAMED_SCORES = """
SELECT account_int, smape, n, account, c_name AS accountname
FROM scores JOIN accounts USING (account_int)
LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = account"""


def _filtered() -> str:
    kept = """account IN (SELECT account FROM top)
  AND ts >= TIMESTAMP '2023-10-01' AND ts < TIMESTAMP '2024-02-01'"""
    return f"""WITH {_SIGNALLING},{_SESSIONS},{_TOP},
kept_signalling AS (SELECT * FROM signalling WHERE {kept}),
kept_sessions AS (SELECT * FROM sessions WHERE {kept}),{_hourly_sql("kept_signalling", "kept_sessions")}
SELECT * FROM hourly"""


def _window_sums(lags: int, horizon: int) -> str:
    def over(first: int, last: int) -> str:
        return (
            "OVER (PARTITION BY account_int, metric_int ORDER BY hour "
            f"ROWS BETWEEN {first} FOLLOWING AND {last} FOLLOWING)"
        )

    x, y = over(0, lags - 1), over(lags, lags + horizon - 1)
    return f"""
windows AS (
  SELECT account_int, metric_int, hour, dayofweek,
         first_value(value) {x} AS x_first, last_value(value) {x} AS x_last,
         first_value(value) {y} AS y_first, last_value(value) {y} AS y_last,
         count(*) {x} AS n_x, count(*) {y} AS n_y,
         sum(value) {x} AS x_sum, sum(value) {y} AS y_sum
  FROM dense
),
samples AS (SELECT * FROM windows WHERE n_x = {lags} AND n_y = {horizon})"""


_SAMPLES = f"{_SERIES},{_window_sums(LAGS, HORIZON)}"

_SPLIT = f"""{_SAMPLES},
split AS (
  SELECT *, CASE WHEN hour BETWEEN TIMESTAMP '{TRAIN[0]}' AND TIMESTAMP '{TRAIN[1]}' THEN 'train'
                 WHEN hour BETWEEN TIMESTAMP '{VALID[0]}' AND TIMESTAMP '{VALID[1]}' THEN 'valid'
            END AS split
  FROM samples
)"""

_POSITIONS = f"""{_SAMPLES},
positions AS (
  SELECT account_int, metric_int, hour, row_number() OVER (
           ORDER BY md5('0:' || account_int || ':' || metric_int || ':' || CAST(hour AS VARCHAR)),
                    account_int, metric_int, hour) - 1 AS position
  FROM samples
)"""

_SAMPLE_SUMMARY = """
SELECT account_int, metric_int, hour, dayofweek, x_first, x_last, y_first, y_last,
       CAST(n_x AS INTEGER) AS n_x, CAST(n_y AS INTEGER) AS n_y,
       round(x_sum, 6) AS x_sum, round(y_sum, 6) AS y_sum
FROM samples"""

_SINGLE_HOURLY = (
    f"WITH {_SIGNALLING},{_SESSIONS},".replace("CAST(user_id AS VARCHAR)", "'all'") + _hourly_sql()
)

_SINGLE = f"""{_SINGLE_HOURLY},{_ACCOUNTS},
metric_ids AS (
  SELECT metric, CAST(row_number() OVER (ORDER BY metric) - 1 AS INTEGER) AS metric_int
  FROM (SELECT DISTINCT metric FROM hourly)
),{_GRID},{_DENSE},{_window_sums(LAGS, HORIZON)}{_SAMPLE_SUMMARY}"""


def _given_weights_sql(keys_out: str) -> str:
    """The network layer by layer, each a join of cells with weights."""
    net = SMALL_NET
    keys = net.account_dim + net.metric_dim
    names = list(shapes(net, len(METRIC_IDS)))

    def weight(name: str, row: str, column: str) -> str:
        return f"(((7 * {row} + 3 * {column} + {names.index(name)}) % 17 - 8) / 40.0)"

    def layer(into: str, source: str, name: str, size: int, shape: str) -> str:
        value = f"sum(v * CAST({weight(name, 'i', 'j')} AS DOUBLE)) + {weight(name + '_bias', 'j', '0')}"
        return f"""
{into} AS (
  SELECT account_int, metric_int, j AS i, {shape.format(value)} AS v
  FROM {source}, range(0, {size}) AS columns(j) GROUP BY 1, 2, 3
)"""

    relu, sigmoid = "greatest(0, {})", "1 / (1 + exp(-({})))"
    parts = [
        (0, net.account_dim, f"(((7 * account_int + 3 * i + {ACCOUNT_SHIFT}) % 17 - 8) / 40.0)"),
        (net.account_dim, net.metric_dim, weight("metric", "metric_int", "i")),
        (keys, net.weekday_dim, weight("weekday", "dayofweek", "i")),
    ]
    embedded = "\n  UNION ALL\n  ".join(
        f"SELECT account_int, metric_int, {at} + i AS i, CAST({value} AS DOUBLE) AS v "
        f"FROM latest, range(0, {size}) AS cells(i)"
        for at, size, value in parts
    )
    first = f"TIMESTAMP '{GRID[1]}' - INTERVAL {net.lags} HOUR"
    return f"""{_SERIES},
latest AS (SELECT * FROM dense WHERE hour = {first}),
embedded AS (
  {embedded}
),{layer("relu1", "embedded", "relu1", net.relu_width, relu)},{layer("relu2", "relu1", "relu2", net.relu_width, relu)},
joined AS (
  SELECT * FROM relu2
  UNION ALL
  SELECT account_int, metric_int, {net.relu_width} + date_diff('hour', {first}, hour), ln(value)
  FROM dense WHERE hour >= {first}
),{layer("wide", "joined", "wide", net.hidden, sigmoid)},{layer("out", "wide", "out", net.horizon, "{}")}
SELECT {keys_out}, hour, dayofweek, CAST(i AS INTEGER) AS step, CAST(exp(v) AS FLOAT) AS yhat
FROM out JOIN latest USING (account_int, metric_int)
JOIN accounts USING (account_int) JOIN metric_ids USING (metric_int)"""


def _network_sql() -> tuple[str, str]:
    """Forward and backward pass as columns of every window, and the sums of the
    gradient.

    e: embeddings, a and b: relu layers, s: sigmoid layer, d: error of the
    output; da, db, ds: errors ahead of the activations; l: log values.
    """
    net = TINY_NET
    weights = given_weights(net)
    n_keys = net.account_dim + net.metric_dim + net.weekday_dim
    relu, hidden, horizon = net.relu_width, net.hidden, net.horizon
    below = [f"b{i}" for i in range(relu)] + [f"l{i}" for i in range(net.lags)]

    def dot(values: list[str], factors: np.ndarray) -> str:
        return " + ".join(f"{v} * ({float(f)!r}::DOUBLE)" for v, f in zip(values, factors))

    def layer(values: list[str], name: str, shape: str, into: str) -> str:
        bias = weights[f"{name}_bias"]
        cells = (
            shape.format(f"{dot(values, column)} + ({float(bias[j])!r}::DOUBLE)") + f" AS {into}{j}"
            for j, column in enumerate(weights[name].T)
        )
        return ", ".join(cells)

    def back(errors: list[str], name: str, rows: int, slope: str, into: str) -> str:
        cells = (
            f"({dot(errors, weights[name][i])}) * {slope.format(i=i)} AS {into}{i}"
            for i in range(rows)
        )
        return ", ".join(cells)

    def columns(prefix: str, n: int) -> list[str]:
        return [f"{prefix}{i}" for i in range(n)]

    def embedding(rule: str, name: str | None, at: int, size: int) -> str:
        shift = ACCOUNT_SHIFT if name is None else list(weights).index(name)
        return ", ".join(
            f"((7 * {rule} + {3 * j + shift}) % 17 - 8) / 40::DOUBLE AS e{at + j}"
            for j in range(size)
        )

    after = ", ".join(
        f"ln(lead(value, {i}) OVER series) AS l{i}" for i in range(net.width)
    )
    keys = ", ".join(
        [
            embedding("account_int", None, 0, net.account_dim),
            embedding("metric_int", "metric", net.account_dim, net.metric_dim),
            embedding("dayofweek", "weekday", net.account_dim + net.metric_dim, net.weekday_dim),
        ]
    )
    errors = ", ".join(
        f"{cell.rsplit(' AS ', 1)[0]} - l{net.lags + h} AS d{h}"
        for h, cell in enumerate(layer(columns("s", hidden), "out", "{}", "d").split(", "))
    )
    step = "(CASE WHEN {0}{{i}} > 0 THEN 1 ELSE 0 END)"
    pairs = {
        "out": (columns("s", hidden), columns("d", horizon)),
        "wide": (below, columns("ds", hidden)),
        "relu2": (columns("a", relu), columns("db", relu)),
        "relu1": (columns("e", n_keys), columns("da", relu)),
    }
    cells = [("loss", 0, 0, " + ".join(f"d{h} * d{h} / 2" for h in range(horizon)))]
    for name, (values, outer) in pairs.items():
        cells += [
            (name, i, j, f"{v} * {d}") for i, v in enumerate(values) for j, d in enumerate(outer)
        ]
        cells += [(f"{name}_bias", j, 0, d) for j, d in enumerate(outer)]
    sums = ", ".join(f"sum({cell}) AS g{k}" for k, (*_, cell) in enumerate(cells))
    rows = [
        f"SELECT '{name}' AS name, {i} AS i, {j} AS j, g{k} AS total FROM sums"
        for k, (name, i, j, _) in enumerate(cells)
    ]
    at = 0
    for name, key, size in (
        ("account", "account_int", net.account_dim),
        ("metric", "metric_int", net.metric_dim),
        ("weekday", "dayofweek", net.weekday_dim),
    ):
        rows += [
            f"SELECT '{name}', {key}, {j}, sum(de{at + j}) FROM errors GROUP BY {key}"
            for j in range(size)
        ]
        at += size
    forward = f"""{_SERIES},
shifted AS (
  SELECT *, {after} FROM dense WINDOW series AS (PARTITION BY account_int, metric_int ORDER BY hour)
),
embedded AS (SELECT *, {keys} FROM shifted WHERE l{net.width - 1} IS NOT NULL),
first AS (SELECT *, {layer(columns("e", n_keys), "relu1", "greatest(0, {})", "a")} FROM embedded),
second AS (SELECT *, {layer(columns("a", relu), "relu2", "greatest(0, {})", "b")} FROM first),
wide AS (SELECT *, {layer(below, "wide", "1 / (1 + exp(-({})))", "s")} FROM second),
output AS (SELECT *, {errors} FROM wide)"""

    ahead_wide = back(columns("d", horizon), "out", hidden, "s{i} * (1 - s{i})", "ds")
    ahead_relu2 = back(columns("ds", hidden), "wide", relu, step.format("b"), "db")
    ahead_relu1 = back(columns("db", relu), "relu2", relu, step.format("a"), "da")
    of_keys = back(columns("da", relu), "relu1", n_keys, "1", "de")
    chain = " UNION ALL\n".join(rows)
    gradient = f"""{forward},
back1 AS (SELECT *, {ahead_wide} FROM output),
back2 AS (SELECT *, {ahead_relu2} FROM back1),
back3 AS (SELECT *, {ahead_relu1} FROM back2),
errors AS MATERIALIZED (SELECT *, {of_keys} FROM back3),
sums AS MATERIALIZED (SELECT {sums} FROM errors)
SELECT name, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       round(total / (SELECT count(*) FROM errors), 6) AS mean
FROM (
{chain}
)"""

    predicted = " UNION ALL ".join(
        f"SELECT account_int, exp(l{net.lags + h}) AS y, "
        f"CAST(CAST(exp(d{h} + l{net.lags + h}) AS FLOAT) AS DOUBLE) AS yhat FROM output"
        for h in range(horizon)
    )
    scores = f"""{forward},
cells AS ({predicted}),
scores AS (SELECT account_int, {_SMAPE} FROM cells GROUP BY 1){_NAMED_SCORES}"""
    return gradient, scores


def _training_step_sql(training_gradient: str) -> str:
    """Weights by the rule, moved by the first update of Adam: the rate times the sign of the
    gradient, but for the stabiliser."""
    sizes = {name: (shape[0], shape[1] if len(shape) > 1 else 1) for name, shape in shapes(TINY_NET, len(METRIC_IDS)).items()}
    shifts = {name: k for k, name in enumerate(sizes)} | {"account": ACCOUNT_SHIFT}
    shift = "CASE name " + " ".join(f"WHEN '{n}' THEN {k}" for n, k in shifts.items()) + " END"
    every = " UNION ALL ".join(
        f"SELECT '{name}' AS name, i, j FROM range(0, {rows}) AS r(i), range(0, {columns}) AS c(j)"
        for name, (rows, columns) in sizes.items()
    )
    exact = training_gradient.replace("round(total / (SELECT count(*) FROM errors), 6) AS mean", "total")
    return f"""
WITH gradient AS ({exact}),
every AS (
  {every}
  UNION ALL SELECT 'account', i, j FROM gradient WHERE name = 'account'
)
SELECT name, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(
  ((7 * i + 3 * j + {shift}) % 17 - 8) / 40.0 - CASE WHEN coalesce(total, 0) = 0 THEN 0.0 ELSE
    CAST(0.01 * sqrt(1 - 0.999) / (1 - 0.9) AS DOUBLE) * 0.1 * total / (sqrt(0.001 * total * total) + 1e-8) END, 6) AS weight
FROM every LEFT JOIN gradient USING (name, i, j)"""


def _neighbours_sql() -> str:
    """Cosines between the rows of two embeddings by the rule."""
    names = list(shapes(SMALL_NET, len(METRIC_IDS)))
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    weekdays = ", ".join(f"({k}, '{day}')" for k, day in enumerate(days))

    def report(embedding: str, labels: str, dim: int) -> str:
        def cell(row: str) -> str:
            return f"(((7 * {row} + 3 * k + {names.index(embedding)}) % 17 - 8) / 40.0)"

        def total(one: str, two: str) -> str:
            cells = f"range(0, {dim}), lambda k: CAST({cell(one)} * {cell(two)} AS DOUBLE)"
            return f"list_sum(list_transform({cells}))"

        return f"""
SELECT '{embedding}' AS embedding, label, CAST(rank AS INTEGER) AS rank, neighbour, round(cosine, 6) AS cosine
FROM (
  SELECT label, neighbour, cosine, row_number() OVER (PARTITION BY i ORDER BY cosine DESC, j) AS rank
  FROM (
    SELECT a.label, b.label AS neighbour, a.id AS i, b.id AS j,
      round({total("a.id", "b.id")} / sqrt({total("a.id", "a.id")}) / sqrt({total("b.id", "b.id")}), 9) AS cosine
    FROM {labels} a JOIN {labels} b ON a.id <> b.id
  ) WHERE NOT isnan(cosine)
) WHERE rank <= 3"""

    return f"""{_HOURLY},
metric_labels AS (SELECT row_number() OVER (ORDER BY metric) - 1 AS id, metric AS label FROM (SELECT DISTINCT metric FROM hourly)),
rows AS (SELECT id FROM range(0, {len(METRIC_IDS)}) AS r(id)),
metrics AS (SELECT id, label FROM rows LEFT JOIN metric_labels USING (id)),
weekdays(id, label) AS (VALUES {weekdays})
{report("metric", "metrics", SMALL_NET.metric_dim)}
UNION ALL
{report("weekday", "weekdays", SMALL_NET.weekday_dim)}"""


def _orders_sql(kept: str = "true") -> str:
    """The hourly table of the orders that meet a condition, made at once."""

    def counted(metric: str, value: str, where: str = "true") -> str:
        return (
            f"SELECT account, hour, {metric} AS metric, {value} AS value FROM kept "
            f"WHERE {where} GROUP BY account, hour, metric"
        )

    parts = [
        counted("CASE op WHEN 'F' THEN 'countUL' ELSE 'countCL' END", "count(*)", "op IN ('F', 'O')"),
        counted("'mapsum'", "count(*)", "op IS NOT NULL"),
        counted("'createPdpCountV1'", "count(*)"),
        counted("'deletePdpCountV1'", "0"),
        counted("'imsiSum'", "count(DISTINCT subscriber)"),
    ]
    union = "\n  UNION ALL ".join(parts)
    return f"""
WITH orders_of AS (
  SELECT CAST(o_custkey AS VARCHAR) AS account, o_orderdate AS ts, date_trunc('hour', o_orderdate) AS hour,
         o_orderstatus AS op, o_orderpriority AS subscriber FROM orders
),
top AS (SELECT account FROM orders_of GROUP BY account ORDER BY count(*) DESC, account LIMIT 100),
kept AS (SELECT * FROM orders_of WHERE {kept}),
hourly AS (
  {union}
)
SELECT account, hour, CAST(isodow(hour) AS INTEGER) AS day_of_week, metric, CAST(value AS BIGINT) AS value
FROM hourly"""


def oracle_sql() -> dict[str, str]:
    training_gradient, score_given_weights = _network_sql()
    hourly_rows = f"{_HOURLY} SELECT * FROM hourly"
    ids = f"{_HOURLY},{_ACCOUNTS},{_METRICS}"
    wide = ", ".join(
        f'round(sum(lead_{i}), 6) AS "{i}"' if i else 'round(sum(value), 6) AS "0"'
        for i in range(6)
    )
    leads = ", ".join(
        f"lead(value, {i}) OVER (PARTITION BY account_int, metric_int ORDER BY hour) AS lead_{i}"
        for i in range(1, 6)
    )
    wide_sums = f"""{_SERIES},
shifted AS (SELECT *, {leads} FROM dense)
SELECT account_int, metric_int, count(*) AS n, {wide}
FROM shifted WHERE lead_5 IS NOT NULL GROUP BY 1, 2"""
    reach = f"""hour >= TIMESTAMP '{VALID[0]}'
  AND hour <= TIMESTAMP '{VALID[1]}' + INTERVAL {LAGS + HORIZON - 1} HOUR"""
    return {
        "hourly_of_windows": f"{_HOURLY} SELECT * FROM hourly WHERE {reach}",
        "month_table_pruning": f"""
SELECT CAST(o_custkey AS VARCHAR) AS account, o_orderdate AS ts, o_orderstatus AS op,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE (year(o_orderdate), month(o_orderdate)) IN (
  SELECT (year(o_orderdate), month(o_orderdate)) FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_totalprice > {DEAR})""",
        "late_events": _orders_sql(),
        "training_table_orders": _orders_sql(
            "account IN (SELECT account FROM top) "
            "AND ts >= TIMESTAMP '1999-11-01' AND ts < TIMESTAMP '2000-03-01'"
        ),
        "training_step": _training_step_sql(training_gradient),
        "neighbour_report_given": _neighbours_sql(),
        "samples_csv_splits": f"""{_SPLIT}
SELECT split, account_int, metric_int, hour, dayofweek, x_first, x_last, y_first, y_last,
       CAST(n_x AS INTEGER) AS n_x, CAST(n_y AS INTEGER) AS n_y,
       round(x_sum, 6) AS x_sum, round(y_sum, 6) AS y_sum
FROM split WHERE split IS NOT NULL""",
        "hourly_opcode_counts": f"WITH {_SIGNALLING},{_opcode_counts()} SELECT * FROM opcode_counts",
        "hourly_conditional_counts": (
            f"WITH {_SESSIONS},{_conditional_counts()} SELECT * FROM conditional_counts"
        ),
        "hourly_distinct_subscribers": (
            f"WITH {_SESSIONS},{_subscribers()} SELECT * FROM subscribers"
        ),
        "hourly_metrics": hourly_rows,
        "top_accounts": f"WITH {_SIGNALLING},{_TOP} SELECT * FROM top",
        "top_accounts_filter": (
            f"WITH {_SIGNALLING},{_TOP} SELECT account, ts, op FROM signalling "
            "WHERE account IN (SELECT account FROM top)"
        ),
        "last_months_filter": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice
FROM orders
WHERE (month(o_orderdate), year(o_orderdate)) IN ((11, 1999), (12, 1999), (1, 2000), (2, 2000))""",
        "month_table_filter": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE month(o_orderdate) IN (SELECT month(ts) FROM events)""",
        "training_table": _filtered(),
        "sql_file_query": _filtered(),
        "encode_keys": f"""{ids}
SELECT account, account_int, hour, metric, metric_int, value
FROM hourly LEFT JOIN accounts USING (account) LEFT JOIN metric_ids USING (metric)""",
        "decode_keys": f"""{ids}
SELECT account, account_int, hour, metric, metric_int, value
FROM hourly JOIN accounts USING (account) JOIN metric_ids USING (metric)""",
        "key_grid": f"WITH {_SIGNALLING},{_ACCOUNTS},{_METRICS},{_GRID} SELECT * FROM grid",
        "densify": f"{_SERIES} SELECT * FROM dense",
        "series_lead": f"""{_SERIES}
SELECT *, lead(value, 1) OVER w AS lead_1, lead(value, 24) OVER w AS lead_24,
       lead(value, 168) OVER w AS lead_168
FROM dense WINDOW w AS (PARTITION BY account_int, metric_int ORDER BY hour)""",
        "make_samples": f"{_SAMPLES}{_SAMPLE_SUMMARY}",
        "single_account_samples": _SINGLE,
        "forecast_given_weights": _given_weights_sql("account_int, metric_int"),
        "forecast_stored_weights": _given_weights_sql("account, metric"),
        "score_stored_weights": score_given_weights,
        "training_gradient": training_gradient,
        "score_given_weights": score_given_weights,
        "samples_wide": wide_sums,
        "samples_csv_roundtrip": wide_sums,
        "single_account_csv": f"{_SINGLE_HOURLY} SELECT * FROM hourly",
        "account_dictionary": """
SELECT CAST(c_custkey AS VARCHAR) AS account, c_name AS accountname,
       CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS INTEGER) AS account_int
FROM customer""",
        "split_by_time": f"""{_SPLIT}
SELECT split, account_int, metric_int, count(*) AS n, min(hour) AS first_hour,
       max(hour) AS last_hour
FROM split WHERE split IS NOT NULL GROUP BY 1, 2, 3""",
        "spot_check": f"{_SERIES} SELECT * FROM dense WHERE hour = TIMESTAMP '{SPOT}'",
        "smape": f"{_SERIES},{_CELLS} SELECT {_SMAPE} FROM cells",
        "score_by_account": f"""{_SERIES},{_CELLS},
scores AS (SELECT account_int, {_SMAPE} FROM cells GROUP BY 1){_NAMED_SCORES}""",
        "log_l2_loss": f"""{_SERIES},{_CELLS}
SELECT account_int, metric_int, round(sum((ln(y) - ln(yhat)) ** 2) / 2, 4) AS loss, count(*) AS n
FROM cells GROUP BY 1, 2""",
        "embedding_lookup": """
WITH vectors AS (
  SELECT event_id, CASE WHEN u.embedding IS NOT NULL AND d.embedding IS NOT NULL
                        THEN list_concat(u.embedding, d.embedding) END AS vec
  FROM events LEFT JOIN embeddings u ON u.vec_id = user_id
  LEFT JOIN embeddings d ON d.vec_id = isodow(ts) - 1
)
SELECT event_id, CAST(len(vec) AS INTEGER) AS n,
       round(list_sum(list_transform(range(1, len(vec) + 1),
                                     lambda i: i * CAST(vec[i] AS DOUBLE))), 6) AS weighted_sum
FROM vectors""",
        "embedding_topk": _TOPK,
        "embedding_pivots": _TOPK,
        "daily_subscribers": f"""
WITH {_SESSIONS}
SELECT account, date_trunc('day', ts) AS day, count(DISTINCT subscriber) AS subscribers
FROM sessions WHERE subscriber IS NOT NULL GROUP BY 1, 2""",
        "shuffle_samples": f"{_POSITIONS} SELECT * FROM positions",
        "batches": f"""{_POSITIONS}
SELECT account_int, metric_int, hour, CAST(position // 10000 AS INTEGER) AS batch FROM positions""",
        "csv_roundtrip": hourly_rows,
        "parquet_roundtrip": hourly_rows,
        "events_roundtrip": """
SELECT CAST(o_custkey AS VARCHAR) AS account, o_orderdate AS ts, o_orderstatus AS op,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-11-01' AND o_orderdate < TIMESTAMP '2000-03-01'""",
        "samples_roundtrip": f"""{_SPLIT}
SELECT split, account_int, metric_int, count(*) AS n, round(sum(x_first), 6) AS x_sum,
       round(sum(y_first), 6) AS y_sum
FROM split WHERE split IS NOT NULL GROUP BY 1, 2, 3""",
    }
