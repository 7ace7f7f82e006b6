"""Queries on series: daily order value per priority, and the event stream per type.

The daily series are one aggregation of the whole orders table; everything after it works on at
most one row per day and series. The event series keep every row, so they go through
``with_position``, which does not put a series into one task.
"""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators import joins as J
from cuadra.operators import order as O
from cuadra.operators import stationarity as S
from cuadra.operators import timeseries as T
from cuadra.operators import windows as W
from cuadra.operators.models import lag_forecast
from cuadra.operators.position import with_position
from cuadra.plans.registry import Tables, query
from cuadra.plans.table_queries import rounded
from cuadra.session import written_once

KEYS = ["k"]


def daily_series(t: Tables) -> DataFrame:
    """One row per day and series, written once: the steps below read it more than once."""
    return written_once(
        t.orders.groupBy(F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("ts")).agg(
            F.round(F.sum("o_totalprice"), 2).alias("x")
        )
    )


def business_grid(t: Tables) -> DataFrame:
    return T.regular_grid(daily_series(t), "ts", KEYS, "B")


def filled_series(t: Tables) -> DataFrame:
    """The business-day series with its gaps carried forward, then back at the start."""
    forward = W.ffill(business_grid(t), ["x"], KEYS, "pos", size=None)
    return written_once(W.bfill(forward, ["x"], KEYS, "pos", size=None))


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("string"))


BASE = """
WITH daily AS (
  SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS ts, round(sum(o_totalprice), 2) AS x FROM orders GROUP BY ALL
), ends AS (SELECT k, min(ts) AS a, max(ts) AS b FROM daily GROUP BY k
), days AS (SELECT k, CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS ts FROM ends
), every_day AS (
  SELECT k, ts, row_number() OVER (PARTITION BY k ORDER BY ts) - 1 AS pos, x FROM days LEFT JOIN daily USING (k, ts)
), business AS (
  SELECT k, ts, row_number() OVER (PARTITION BY k ORDER BY ts) - 1 AS pos, x
  FROM days LEFT JOIN daily USING (k, ts) WHERE isodow(ts) <= 5
), forward AS (
  SELECT k, ts, pos, last_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY pos ROWS UNBOUNDED PRECEDING) AS x FROM business
), filled AS (
  SELECT k, ts, pos, first_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x
  FROM forward
), sized AS (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM filled
), split AS (SELECT k, ts, pos, x, CASE WHEN pos < n - 100 THEN 'train' ELSE 'test' END AS part FROM sized
), ends2 AS (SELECT k, min(x) AS lo, max(x) AS hi FROM split WHERE part = 'train' GROUP BY k)
"""


# ---- calendar and fills -------------------------------------------------------------------


@query("""
SELECT o_orderkey, CAST(CAST(try_strptime(s, '%d/%m/%Y') AS DATE) AS VARCHAR) AS ts
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS s FROM orders)""")
def date_index(t):
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return dated(T.date_index(t.orders.select("o_orderkey", text.alias("s")), "s").drop("s"))


@query(BASE + "SELECT k, CAST(ts AS VARCHAR) AS ts, pos, x FROM every_day")
def grid_daily(t):
    return dated(T.regular_grid(daily_series(t), "ts", KEYS, "D"))


@query(BASE + "SELECT k, CAST(ts AS VARCHAR) AS ts, pos, x FROM business")
def grid_business(t):
    return dated(business_grid(t))


@query(BASE + "SELECT k, CAST(ts AS VARCHAR) AS ts, pos, x FROM forward")
def fill_forward(t):
    return dated(W.ffill(business_grid(t), ["x"], KEYS, "pos", size=None))


@query(BASE + """
SELECT k, CAST(ts AS VARCHAR) AS ts, pos,
       first_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x
FROM business""")
def fill_back(t):
    return dated(W.bfill(business_grid(t), ["x"], KEYS, "pos", size=None))


@query(BASE + """
SELECT a.k, CAST(a.ts AS VARCHAR) AS ts, a.pos, a.x, b.x AS other
FROM business a LEFT JOIN (SELECT ts, x FROM daily WHERE k = '2-HIGH') b ON a.ts = b.ts""")
def align_on_time(t):
    other = daily_series(t).filter(F.col("k") == "2-HIGH").drop("k")
    return dated(J.align_on_time(business_grid(t), other, [], "ts", "x", "other"))


# ---- long series: one row per event --------------------------------------------------------


def _events(t: Tables) -> DataFrame:
    placed = with_position(t.events.select("event_type", "event_id", "ts", "value"), ["ts", "event_id"], ["event_type"])
    return placed.drop("ts").withColumn("seen", F.when(F.col("value") > 20, F.col("value")))


EVENTS = """
WITH e AS (SELECT event_type, event_id, value, CASE WHEN value > 20 THEN value END AS seen,
                  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos FROM events)
"""


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events")
def row_position(t):
    return with_position(t.events.select("event_id", "ts"), ["ts", "event_id"]).drop("ts")


@query(EVENTS + """
SELECT event_type, event_id, pos, last_value(seen IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seen
FROM e""")
def fill_forward_events(t):
    return W.ffill(_events(t).drop("value"), ["seen"], ["event_type"], "pos")


@query(EVENTS + """
SELECT event_type, event_id, pos,
       first_value(seen IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS seen
FROM e""")
def fill_back_events(t):
    return W.bfill(_events(t).drop("value"), ["seen"], ["event_type"], "pos")


@query(EVENTS + """
SELECT event_type, event_id, pos, round(100 + sum(value) OVER (PARTITION BY event_type ORDER BY pos ROWS UNBOUNDED PRECEDING), 2) AS walk
FROM e""")
def cumulative_sum(t):
    walk = W.cumulative_sum(_events(t), "value", ["event_type"], "pos", "walk", start=100.0)
    return rounded(walk.drop("value", "seen"), ["walk"], 2)


@query(EVENTS + """
SELECT event_type, pos, value AS y, lag(value, 7) OVER w AS oldest, lag(value, 1) OVER w AS newest,
       round(lag(value, 1) OVER w + lag(value, 2) OVER w + lag(value, 3) OVER w + lag(value, 4) OVER w + lag(value, 5) OVER w
             + lag(value, 6) OVER w + lag(value, 7) OVER w, 2) AS total
FROM e WINDOW w AS (PARTITION BY event_type ORDER BY pos) QUALIFY pos >= 7""")
def lag_windows_events(t):
    windows = W.lag_windows(_events(t), ["value"], "value", 7, ["event_type"], "pos")
    return windows.select("event_type", "pos", "y", *_window_figures("value"))


def _window_figures(col: str):
    values = F.transform("x", lambda s: s[col])
    return [
        F.element_at(values, 1).alias("oldest"),
        F.element_at(values, -1).alias("newest"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 2).alias("total"),
    ]


# ---- splits, windows, scaling -----------------------------------------------------------------


@query(BASE + "SELECT k, CAST(ts AS VARCHAR) AS ts, pos, x, CASE WHEN pos < floor(0.8 * n) THEN 'train' ELSE 'test' END AS part FROM sized")
def chronological_split(t):
    return dated(W.chronological_split(filled_series(t), KEYS, "pos", 0.8))


@query(BASE + "SELECT k, CAST(ts AS VARCHAR) AS ts, pos, x, part FROM split")
def tail_split(t):
    return dated(W.tail_split(filled_series(t), KEYS, "pos", 100))


@query(BASE + """
, c AS (SELECT k, ts, CASE WHEN pos < floor(0.8 * n) THEN 'train' ELSE 'test' END AS part FROM sized)
SELECT k, CAST(ts AS VARCHAR) AS ts, part FROM (SELECT * FROM c WHERE part = 'train' ORDER BY ts DESC, k DESC LIMIT 5)
UNION ALL SELECT k, CAST(ts AS VARCHAR), part FROM (SELECT * FROM c WHERE part = 'test' ORDER BY ts, k LIMIT 5)""")
def edge_rows(t):
    split = W.chronological_split(filled_series(t), KEYS, "pos", 0.8).select("k", "ts", "part")
    return dated(O.edge_rows(split, "part", "ts", "k"))


def _lag_sql(k: int) -> str:
    total = " + ".join(f"lag(x, {j}) OVER w" for j in range(1, k + 1))
    return BASE + f"""
SELECT k, pos, x AS y, lag(x, {k}) OVER w AS oldest, lag(x, 1) OVER w AS newest, round({total}, 2) AS total
FROM filled WINDOW w AS (PARTITION BY k ORDER BY pos) QUALIFY pos >= {k}"""


def _register_lag_windows(k: int) -> None:
    @query(_lag_sql(k), name=f"lag_windows_{k}")
    def run(t):
        return W.lag_windows(filled_series(t), ["x"], "x", k, KEYS, "pos").select("k", "pos", "y", *_window_figures("x"))


for _k in (1, 7, 30):
    _register_lag_windows(_k)


@query(BASE + """
SELECT k, CAST(ts AS VARCHAR) AS ts, pos, part, round((x - lo) / (hi - lo), 8) AS x FROM split JOIN ends2 USING (k)""")
def minmax_scale(t):
    split = W.tail_split(filled_series(t), KEYS, "pos", 100)
    ends = T.minmax_fit(split.filter(F.col("part") == "train"), ["x"], KEYS)
    return rounded(dated(T.minmax_apply(split, ends, ["x"], KEYS)), ["x"], 8)


@query(BASE + "SELECT k, CAST(ts AS VARCHAR) AS ts, pos, part, x FROM split")
def minmax_round_trip(t):
    split = W.tail_split(filled_series(t), KEYS, "pos", 100)
    ends = T.minmax_fit(split.filter(F.col("part") == "train"), ["x"], KEYS)
    scaled = T.minmax_apply(split, ends, ["x"], KEYS)
    return rounded(dated(T.minmax_invert(scaled, ends, ["x"], "x", KEYS)), ["x"], 2)


# ---- decomposition ------------------------------------------------------------------------------


def _average_sql(p: int) -> str:
    h = p // 2
    if p % 2:
        total = f"sum(x) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    else:
        total = (
            f"(sum(x) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN {h - 1} PRECEDING AND {h - 1} FOLLOWING)"
            f" + 0.5 * (lag(x, {h}) OVER (PARTITION BY k ORDER BY pos) + lead(x, {h}) OVER (PARTITION BY k ORDER BY pos)))"
        )
    return f"CASE WHEN pos >= {h} AND pos < n - {h} THEN {total} / {p}.0::DOUBLE END"


def _decompose_sql(p: int, ratio: bool) -> str:
    op, back = ("/", "m / avg(m) OVER (PARTITION BY k)") if ratio else ("-", "m - avg(m) OVER (PARTITION BY k)")
    return BASE + f"""
, trended AS (SELECT k, ts, pos, x, {_average_sql(p)} AS trend FROM sized),
phases AS (SELECT k, pos % {p} AS phase, avg(x {op} trend) AS m FROM trended GROUP BY k, pos % {p}),
cycle AS (SELECT k, phase, {back} AS seasonal FROM phases)
SELECT t.k, CAST(ts AS VARCHAR) AS ts, pos, x, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(x {op} trend {op} seasonal, 6) AS resid
FROM trended t JOIN cycle c ON c.k = t.k AND c.phase = t.pos % {p}"""


def _register_decompose(p: int, model: str) -> None:
    @query(_decompose_sql(p, model == "multiplicative"), name=f"decompose_{model}_{p}")
    def run(t):
        parts = T.decompose(filled_series(t), "x", p, KEYS, "pos", model)
        return rounded(dated(parts), ["trend", "seasonal", "resid"])


def _register_average(p: int) -> None:
    @query(BASE + f"SELECT k, CAST(ts AS VARCHAR) AS ts, pos, x, round({_average_sql(p)}, 6) AS trend FROM sized", name=f"moving_average_{p}")
    def run(t):
        return rounded(dated(W.centered_moving_average(filled_series(t), "x", p, KEYS, "pos", "trend")), ["trend"])


for _p in (5, 12, 60):
    _register_average(_p)
    _register_decompose(_p, "additive")
_register_decompose(5, "multiplicative")
_register_decompose(12, "multiplicative")


# ---- autocorrelation and stationarity -----------------------------------------------------------

# Elimination in SQL. A matrix is a list of rows; a step removes the first row and column and takes their share
# off the rest, so what is left after s steps is the fit on the first s regressors.
_STEP = ("list_transform(m[2:], lambda r: list_transform(range(2, len(r) + 1), lambda c: r[c] - r[1] / m[1][1] * m[1][c]))")
# The same, but the removed row is kept behind the others and is reduced with them: in the end the solution is left.
_SOLVE_STEP = ("list_concat(list_transform(m[2:], lambda r: list_transform(range(2, len(r) + 1), lambda c: r[c] - r[1] / m[1][1] * m[1][c])),"
               " [list_transform(m[1][2:], lambda v: v / m[1][1])])")


def _gram(rows: str, by: str) -> str:
    """Cross products of the list ``z`` of each row, as a matrix for each group."""
    return f"""SELECT {by}, list(line ORDER BY i) AS m FROM (
    SELECT {by}, i, list(s ORDER BY j) AS line FROM (
      SELECT {by}, i, j, sum(z[i] * z[j]) AS s FROM (SELECT {by}, z, i, unnest(range(1, len(z) + 1)) AS j FROM (SELECT {by}, z, unnest(range(1, len(z) + 1)) AS i FROM {rows}))
      GROUP BY ALL) GROUP BY {by}, i) GROUP BY {by}"""


# The normal distribution by its series.
_PHI = "0.5 + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 120), lambda i: {z} ** (2 * i + 1) * sqrt(pi()) / (2.0 ** (i + 1) * gamma(i + 1.5))))"


def _adf_sql(series: str) -> str:
    """The unit root test of ``series`` (k, pos, x), with the lag count of the smallest AIC."""
    tau = "2.1659 + 1.4412 * t + 0.038269 * t ** 2", "1.7339 + 0.93202 * t - 0.12745 * t ** 2 - 0.010368 * t ** 3"
    crit = {"crit_1": (-3.43035, -6.5393, -16.786, -79.433), "crit_5": (-2.86154, -2.8903, -4.234, -40.040), "crit_10": (-2.56677, -1.5384, -2.809, 0.0)}
    return f"""
, c AS (SELECT k, pos, x - avg(x) OVER (PARTITION BY k) AS x, count(*) OVER (PARTITION BY k) AS n FROM ({series})),
d AS (SELECT k, pos, n, lag(x) OVER w AS y1, x - lag(x) OVER w AS dy,
             greatest(least(ceil(12 * (n / 100.0) ** 0.25), floor(n / 2) - 2), 0)::INT AS u FROM c WINDOW w AS (PARTITION BY k ORDER BY pos)),
h AS (SELECT *, list_reverse(list(dy) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN 60 PRECEDING AND CURRENT ROW)) AS past FROM d),
common AS (SELECT k, list_concat([1.0, y1], past[2:u + 1], [dy]) AS z FROM h WHERE pos >= u + 1),
g AS ({_gram("common", "k")}),
e AS (SELECT k, 0 AS step, m FROM g UNION ALL SELECT k, step + 1, {_STEP} FROM e WHERE len(m) > 1),
aic AS (SELECT e.k, step - 2 AS p, (n - 1 - u) * ln(m[-1][-1] / (n - 1 - u)) + 2 * step AS aic
        FROM e JOIN (SELECT DISTINCT k, n, u FROM d) s ON s.k = e.k WHERE step >= 2),
chosen AS (SELECT k, p FROM aic QUALIFY row_number() OVER (PARTITION BY k ORDER BY aic, p) = 1),
final AS (SELECT h.k, list_concat([1.0], past[2:p + 1], [y1, dy]) AS z FROM h JOIN chosen USING (k) WHERE pos >= p + 1),
g2 AS ({_gram("final", "k")}),
e2 AS (SELECT k, m FROM g2 UNION ALL SELECT k, {_STEP} FROM e2 WHERE len(m) > 2),
fit AS (SELECT k, p, n - 1 - p AS n_obs, m[1][1] AS a, m[1][2] AS b, m[2][2] - m[1][2] ** 2 / m[1][1] AS ssr
        FROM e2 JOIN chosen USING (k) JOIN (SELECT DISTINCT k, n FROM d) USING (k) WHERE len(m) = 2),
stat AS (SELECT *, (b / a) / sqrt(ssr / (n_obs - p - 2) / a) AS t FROM fit),
poly AS (SELECT *, CASE WHEN t <= -1.61 THEN {tau[0]} ELSE {tau[1]} END AS zt FROM stat)
SELECT k, round(t, 6) AS statistic, round(CASE WHEN t < -18.83 THEN 0 WHEN t > 2.74 THEN 1 ELSE {_PHI.format(z="zt")} END, 6) AS p_value,
       p::INT AS lags, n_obs, {", ".join(f"round({a} + {b} / n_obs + {c} / n_obs::DOUBLE ** 2 + {d} / n_obs::DOUBLE ** 3, 6) AS {name}" for name, (a, b, c, d) in crit.items())}
FROM poly"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


# Products of lagged values by how many lags a row has, and for each lag the sums over the rows that have it.
_PACF_SQL = """
, c AS (SELECT k, pos, x - avg(x) OVER (PARTITION BY k) AS x, count(*) OVER (PARTITION BY k) AS n FROM filled),
h AS (SELECT k, pos, n, list_reverse(list(x) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN 40 PRECEDING AND CURRENT ROW)) AS past FROM c),
products AS (
  SELECT k, least(pos, 40) AS has, i, j, sum(past[i] * past[j]) AS s, sum(past[i]) AS s1, count(*) AS s0
  FROM (SELECT k, pos, past, i, unnest(range(i, len(past) + 1)) AS j FROM (SELECT k, pos, past, unnest(range(1, len(past) + 1)) AS i FROM h)) GROUP BY ALL),
sums AS (SELECT l.lag, k, i, j, sum(s) AS s, sum(s1) AS s1, sum(s0) AS s0 FROM products, range(1, 41) l(lag) WHERE has >= l.lag AND j <= l.lag + 1 GROUP BY ALL),
cells AS (  -- place 0 is the constant, then the lags, and the value itself comes last
  SELECT lag, k, (CASE WHEN i = 1 THEN lag + 1 ELSE i - 1 END) AS a, (CASE WHEN j = 1 THEN lag + 1 ELSE j - 1 END) AS b, s FROM sums
  UNION SELECT lag, k, (CASE WHEN j = 1 THEN lag + 1 ELSE j - 1 END), (CASE WHEN i = 1 THEN lag + 1 ELSE i - 1 END), s FROM sums
  UNION SELECT lag, k, 0, (CASE WHEN i = 1 THEN lag + 1 ELSE i - 1 END), s1 FROM sums WHERE i = j
  UNION SELECT lag, k, (CASE WHEN i = 1 THEN lag + 1 ELSE i - 1 END), 0, s1 FROM sums WHERE i = j
  UNION SELECT lag, k, 0, 0, s0 FROM sums WHERE i = 1 AND j = 1),
g AS (SELECT lag, k, list(line ORDER BY a) AS m FROM (SELECT lag, k, a, list(s ORDER BY b) AS line FROM cells GROUP BY lag, k, a) GROUP BY lag, k),
e AS (SELECT lag, k, m FROM g UNION ALL SELECT lag, k, """ + _STEP + """ FROM e WHERE len(m) > 2)
SELECT k, lag::INT AS lag, round(m[1][2] / m[1][1], 6) AS pacf, round(1.96 / sqrt(n), 8) AS band
FROM e JOIN (SELECT DISTINCT k, n FROM c) USING (k) WHERE len(m) = 2"""


@query(BASE + """
, m AS (SELECT k, avg(x) AS mu, count(*) AS n FROM filled GROUP BY k),
c AS (SELECT k, pos, x - mu AS e, n FROM filled JOIN m USING (k)),
c0 AS (SELECT k, sum(e * e) AS v FROM c GROUP BY k),
r AS (SELECT a.k, l.lag, max(a.n) AS n, sum(a.e * b.e) / max(v) AS acf
      FROM range(1, 41) l(lag), c a JOIN c0 USING (k), c b WHERE b.k = a.k AND b.pos = a.pos - l.lag GROUP BY a.k, l.lag)
SELECT k, CAST(lag AS INT) AS lag, round(acf, 8) AS acf,
       round(1.96 * sqrt((1 + 2 * coalesce(sum(acf * acf) OVER (PARTITION BY k ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n), 8) AS band
FROM r""")
def acf(t):
    return rounded(T.acf(filled_series(t), "x", KEYS, "pos", 40), ["acf", "band"], 8)


@query(BASE + """
, d AS (SELECT k, x - lag(x) OVER w AS dy, lag(x) OVER w AS y1 FROM filled WINDOW w AS (PARTITION BY k ORDER BY pos)),
s AS (SELECT k, regr_slope(dy, y1) AS b, regr_sxx(dy, y1) AS sxx, regr_syy(dy, y1) AS syy, regr_count(dy, y1) AS n FROM d GROUP BY k)
SELECT k, round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 6) AS statistic, 0 AS lags, CAST(n AS BIGINT) AS n_obs,
       round(-2.86154 - 2.8903 / n - 4.234 / n::DOUBLE ** 2 - 40.040 / n::DOUBLE ** 3, 8) AS crit_5
FROM s""")
def adf_no_lags(t):
    test = S.adf_test(filled_series(t), "x", KEYS, max_lags=0)
    return test.select("k", F.round("statistic", 6).alias("statistic"), "lags", "n_obs", F.round("crit_5", 8).alias("crit_5"))


@query(_recursive(BASE + _adf_sql("SELECT k, pos, x FROM filled")))
def adf_test(t):
    test = S.adf_test(filled_series(t), "x", KEYS)
    return rounded(test, ["statistic", "p_value", "crit_1", "crit_5", "crit_10"])


@query(_recursive(BASE + _adf_sql("SELECT k, pos, 100 + sum(x - mu) OVER (PARTITION BY k ORDER BY pos ROWS UNBOUNDED PRECEDING) AS x FROM (SELECT k, pos, x, avg(x) OVER (PARTITION BY k) AS mu FROM filled)")))
def adf_walk(t):
    """The running total of the demeaned series: a unit root that the test should not reject."""
    series = filled_series(t)
    steps = series.join(series.groupBy("k").agg(F.avg("x").alias("mu")), "k").withColumn("step", F.col("x") - F.col("mu"))
    walk = W.cumulative_sum(steps.select("k", "pos", "step"), "step", KEYS, "pos", "walk", start=100.0)
    return rounded(S.adf_test(walk, "walk", KEYS), ["statistic", "p_value", "crit_1", "crit_5", "crit_10"])


@query(BASE + """
, l AS (SELECT k, x AS y, lag(x, 1) OVER w AS a, lag(x, 2) OVER w AS b FROM filled WINDOW w AS (PARTITION BY k ORDER BY pos)),
one AS (SELECT k, regr_slope(y, a) AS r FROM l WHERE a IS NOT NULL GROUP BY k),
two AS (SELECT k, (covar_pop(y, b) * var_pop(a) - covar_pop(y, a) * covar_pop(a, b)) / (var_pop(a) * var_pop(b) - covar_pop(a, b) ** 2) AS r
        FROM l WHERE b IS NOT NULL GROUP BY k),
n AS (SELECT k, count(*) AS n FROM filled GROUP BY k)
SELECT k, CAST(1 AS INT) AS lag, round(r, 8) AS pacf, round(1.96 / sqrt(n), 8) AS band FROM one JOIN n USING (k)
UNION ALL SELECT k, 2, round(r, 8), round(1.96 / sqrt(n), 8) FROM two JOIN n USING (k)""")
def pacf_two(t):
    return rounded(S.pacf_ols(filled_series(t), "x", KEYS, lags=2), ["pacf", "band"], 8)


@query(_recursive(BASE + _PACF_SQL))
def pacf_ols(t):
    return rounded(rounded(S.pacf_ols(filled_series(t), "x", KEYS, lags=40), ["pacf"]), ["band"], 8)


@query(BASE + """
, u AS (SELECT k, ts, pos, x, (CAST('0x' || substring(md5('5:a:' || k || ':' || pos), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u1,
               (CAST('0x' || substring(md5('5:b:' || k || ':' || pos), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u2 FROM filled),
m AS (SELECT k, avg(x) AS mu, stddev_samp(x) AS sd FROM filled GROUP BY k)
SELECT k, pos, round(mu + sd * sqrt(-2 * ln(u1)) * cos(2 * pi() * u2), 4) AS noise FROM u JOIN m USING (k)""")
def noise_column(t):
    return rounded(T.noise_column(filled_series(t), "x", "pos", "noise", seed=5, keys=KEYS).select("k", "pos", "noise"), ["noise"], 4)


# ---- forecasts --------------------------------------------------------------------------------------


def _naive(t: Tables) -> DataFrame:
    """The value before as the forecast of each row, with the split marker."""
    split = W.tail_split(filled_series(t), KEYS, "pos", 100)
    windows = W.lag_windows(split, ["x"], "x", 1, KEYS, "pos", keep=["part"])
    return windows.select("k", "pos", "part", "y", F.col("x")[0]["x"].alias("pred"))


NAIVE = BASE + """
, naive AS (SELECT k, pos, part, x AS y, lag(x) OVER (PARTITION BY k ORDER BY pos) AS pred FROM split QUALIFY pos >= 1)
"""


@query(NAIVE + """
SELECT k, part, round(avg((y - pred) ** 2), 2) AS mse, round(sqrt(avg((y - pred) ** 2)), 4) AS rmse,
       round(avg(CASE WHEN y <> 0 THEN abs((y - pred) / y) END) * 100, 6) AS mape
FROM naive GROUP BY k, part""")
def forecast_metrics(t):
    m = T.forecast_metrics(_naive(t), "y", "pred", ["k", "part"])
    return rounded(rounded(rounded(m, ["mse"], 2), ["rmse"], 4), ["mape"])


@query(NAIVE + """
SELECT k, pos AS step, 'history' AS series, y AS value FROM naive WHERE part = 'train'
UNION ALL SELECT k, pos, 'true', y FROM naive WHERE part = 'test'
UNION ALL SELECT k, pos, 'prediction', pred FROM naive WHERE part = 'test'""")
def overlay_frame(t):
    return T.overlay_frame(_naive(t), "pos", "y", "pred", "part", KEYS)


def _scaled_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    split = W.tail_split(filled_series(t), KEYS, "pos", 100)
    ends = T.minmax_fit(split.filter(F.col("part") == "train"), ["x"], KEYS)
    return T.minmax_apply(split, ends, ["x"], KEYS), ends


@query(BASE + """
, scaled AS (SELECT k, pos, part, (x - lo) / (hi - lo) AS y, lo, hi FROM split JOIN ends2 USING (k)),
w AS (SELECT *, lag(y) OVER (PARTITION BY k ORDER BY pos) AS p FROM scaled QUALIFY pos >= 1),
f AS (SELECT regr_slope(y, p) AS b, regr_intercept(y, p) AS a FROM w WHERE part = 'train')
SELECT k, pos, part, round(y * (hi - lo) + lo, 2) AS y, round((a + b * p) * (hi - lo) + lo, 2) AS prediction FROM w, f""")
def lag_forecast_1(t):
    scaled, ends = _scaled_split(t)
    forecast = lag_forecast(scaled, "x", 1, KEYS, "pos")
    return rounded(T.minmax_invert(forecast, ends, ["y", "prediction"], "x", KEYS), ["y", "prediction"], 2)


def _forecast_sql(k: int) -> str:
    """The regression on ``k`` lags over the training rows of all series, by elimination, and its errors in the units of the data."""
    return _recursive(BASE + f"""
, scaled AS (SELECT k, pos, part, (x - lo) / (hi - lo) AS y, lo, hi FROM split JOIN ends2 USING (k)),
h AS (SELECT *, list_reverse(list(y) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)) AS past FROM scaled QUALIFY pos >= {k}),
train AS (SELECT 1 AS one, list_concat([1.0], past[2:], [y]) AS z FROM h WHERE part = 'train'),
g AS ({_gram("train", "one")}),
e AS (SELECT 0 AS step, m[:-2] AS m FROM g UNION ALL SELECT step + 1, {_SOLVE_STEP} FROM e WHERE step < {k + 1}),
w AS (SELECT list_transform(m, lambda r: r[1]) AS w FROM e WHERE step = {k + 1}),
f AS (SELECT part, y * (hi - lo) + lo AS y, list_sum(list_transform(range(1, {k + 2}), lambda i: w[i] * (CASE WHEN i = 1 THEN 1.0 ELSE past[i] END))) * (hi - lo) + lo AS pred FROM h, w)
SELECT part, round(avg((y - pred) ** 2), -3) AS mse, round(sqrt(avg((y - pred) ** 2)), 2) AS rmse, round(avg(CASE WHEN y <> 0 THEN abs((y - pred) / y) END) * 100, 5) AS mape FROM f GROUP BY part""")


def _register_forecast(k: int) -> None:
    @query(_forecast_sql(k), name=f"lag_forecast_{k}")
    def run(t):
        scaled, ends = _scaled_split(t)
        forecast = T.minmax_invert(lag_forecast(scaled, "x", k, KEYS, "pos"), ends, ["y", "prediction"], "x", KEYS)
        return rounded(rounded(rounded(T.forecast_metrics(forecast, "y", "prediction", ["part"]), ["mse"], -3), ["rmse"], 2), ["mape"], 5)


for _k in (7, 30):
    _register_forecast(_k)


@query()
def lag_forecast_boosted(t):
    scaled, ends = _scaled_split(t)
    model = GBTRegressor(labelCol="y", maxIter=100, maxDepth=5, stepSize=0.1, seed=1)
    forecast = T.minmax_invert(lag_forecast(scaled, "x", 7, KEYS, "pos", model=model), ends, ["y", "prediction"], "x", KEYS)
    return T.forecast_metrics(forecast, "y", "prediction", ["part"])
