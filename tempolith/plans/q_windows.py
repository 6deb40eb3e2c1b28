"""Window-family queries (W1-W22, W25) bound to the EV and OR frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempolith.operators import ewm as E
from tempolith.operators import windows as W
from tempolith.plans.bindings import EV_ORDER, OR_ORDER, ev, ev_gaps, orders_frame, round_doubles, snap
from tempolith.plans.catalog import register

ALPHA = 2.0 / 22.0
ALPHA_SQL = "(2.0/22.0)"


# W1 lags ------------------------------------------------------------------------
@register("lag_features", """
SELECT event_id, user_id,
       lag(value, 1) OVER w AS value_lag1,
       lag(value, 2) OVER w AS value_lag2
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def lag_features(spark, sf):
    df = W.lags(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    return df.select("event_id", "user_id", "value_lag1", "value_lag2")


# W2 expanding ---------------------------------------------------------------------
@register("expanding_stats", """
SELECT event_id, user_id,
       SNAP(avg(value) OVER w) AS value_exp_mean,
       SNAP(stddev_samp(value) OVER w) AS value_exp_std,
       SNAP(max(value) OVER w) AS value_exp_max,
       SNAP(min(value) OVER w) AS value_exp_min
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def expanding_stats(spark, sf):
    df = W.expanding(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    return round_doubles(df.select("event_id", "user_id", "value_exp_mean", "value_exp_std",
                                   "value_exp_max", "value_exp_min"))


# W2 with NULL gaps -----------------------------------------------------------------
@register("expanding_stats_gaps", """
WITH g AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
SELECT event_id, user_id,
       SNAP(avg(value) OVER w) AS value_exp_mean,
       SNAP(stddev_samp(value) OVER w) AS value_exp_std,
       SNAP(max(value) OVER w) AS value_exp_max,
       SNAP(min(value) OVER w) AS value_exp_min
FROM g
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def expanding_stats_gaps(spark, sf):
    df = W.expanding(ev_gaps(spark, sf), ["value"], "user_id", EV_ORDER)
    return round_doubles(df.select("event_id", "user_id", "value_exp_mean", "value_exp_std",
                                   "value_exp_max", "value_exp_min"))


# W3 percentile rank of the expanding mean within the date ----------------------------
# Oracle counts smaller and equal values by a self-join instead of rank windows.
@register("expanding_mean_date_rank", """
WITH f AS (
  SELECT event_id, ts::date AS d,
         SNAP(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS m
  FROM events),
c AS (
  SELECT a.event_id,
         count(*) FILTER (WHERE b.m < a.m) AS n_less,
         count(*) FILTER (WHERE b.m = a.m) AS n_eq,
         count(b.m) AS n
  FROM f a JOIN f b ON a.d = b.d
  WHERE a.m IS NOT NULL
  GROUP BY a.event_id)
SELECT f.event_id, f.d,
       SNAP(f.m) AS value_exp_mean,
       SNAP((c.n_less + (c.n_eq + 1) / 2.0) / c.n) AS value_exp_mean_prank
FROM f LEFT JOIN c USING (event_id)
""")
def expanding_mean_date_rank(spark, sf):
    df = W.expanding(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    # rank the stored feature (float ties must be the same in every engine)
    df = df.withColumn("value_exp_mean", snap("value_exp_mean"))
    df = W.pct_rank_within(df, "d", ["value_exp_mean"])
    return round_doubles(df.select("event_id", "d", "value_exp_mean", "value_exp_mean_prank"))


# W4-W6 rolling 5 -------------------------------------------------------------------
ROLL_SQL = """
WITH b AS (SELECT event_id, user_id, ts, {value} AS value FROM events),
l AS (
  SELECT event_id, user_id,
         lag(value, 5) OVER w AS x0, lag(value, 4) OVER w AS x1, lag(value, 3) OVER w AS x2,
         lag(value, 2) OVER w AS x3, lag(value, 1) OVER w AS x4
  FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (
  SELECT *, (x0 + x1 + x2 + x3 + x4) / 5.0 AS mu FROM l
  WHERE x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL AND x4 IS NOT NULL)
SELECT l.event_id, l.user_id,
       SNAP(m.mu) AS value_roll_mean,
       SNAP(sqrt(((m.x0-m.mu)^2 + (m.x1-m.mu)^2 + (m.x2-m.mu)^2 + (m.x3-m.mu)^2 + (m.x4-m.mu)^2) / 4.0)) AS value_roll_std,
       SNAP(greatest(m.x0, m.x1, m.x2, m.x3, m.x4)) AS value_roll_max,
       SNAP(least(m.x0, m.x1, m.x2, m.x3, m.x4)) AS value_roll_min,
       SNAP((abs(m.x0-m.mu) + abs(m.x1-m.mu) + abs(m.x2-m.mu) + abs(m.x3-m.mu) + abs(m.x4-m.mu)) / 5.0) AS value_roll_mad,
       SNAP((-2*m.x0 - m.x1 + m.x3 + 2*m.x4) / 10.0) AS value_roll_trend
FROM l LEFT JOIN m USING (event_id)
"""
ROLL_COLS = ["value_roll_mean", "value_roll_std", "value_roll_max", "value_roll_min",
             "value_roll_mad", "value_roll_trend"]


@register("rolling_stats", ROLL_SQL.format(value="value"))
def rolling_stats(spark, sf):
    df = W.rolling(ev(spark, sf), ["value"], "user_id", EV_ORDER, n=5)
    return round_doubles(df.select("event_id", "user_id", *ROLL_COLS))


@register("rolling_stats_gaps", ROLL_SQL.format(value="CASE WHEN event_id % 7 <> 0 THEN value END"))
def rolling_stats_gaps(spark, sf):
    df = W.rolling(ev_gaps(spark, sf), ["value"], "user_id", EV_ORDER, n=5)
    return round_doubles(df.select("event_id", "user_id", *ROLL_COLS))


# W7-W11 EWM -------------------------------------------------------------------------
# Oracle: gap-free closed form as an explicit weighted self-join,
# weight of the first value (1-a)^(n-1), later values a(1-a)^(n-j); the
# bias-corrected variance is sum w (x-m)^2 / (1 - sum w^2).
EWM_SQL = f"""
WITH r AS (
  SELECT event_id, user_id, ts, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
p AS (  -- prev values are rows 1..rn-1, position j among them
  SELECT a.event_id, a.user_id, a.rn, b.rn AS j, b.value AS x,
         CASE WHEN b.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
              ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - b.rn) END AS wt
  FROM r a JOIN r b ON a.user_id = b.user_id AND b.rn < a.rn),
m AS (SELECT event_id, sum(wt * x) AS mu, sum(wt * wt) AS w2 FROM p GROUP BY event_id),
v AS (
  SELECT p.event_id, sum(p.wt * (p.x - m.mu) ^ 2) AS cov
  FROM p JOIN m USING (event_id) GROUP BY p.event_id),
f AS (
  SELECT r.event_id, r.user_id, r.ts, r.ts::date AS d,
         lag(r.value) OVER (PARTITION BY r.user_id ORDER BY r.ts, r.event_id) AS prev,
         m.mu,
         CASE WHEN 1 - m.w2 > 1e-9 THEN sqrt(v.cov / (1 - m.w2)) END AS sd
  FROM r LEFT JOIN m USING (event_id) LEFT JOIN v USING (event_id)),
g AS (
  SELECT *, coalesce(CASE WHEN prev > mu THEN 1 ELSE 0 END, 0) AS above FROM f)
SELECT event_id, user_id,
       SNAP(mu) AS value_ewm_mean,
       SNAP(sd) AS value_ewm_std,
       SNAP12((prev - mu) / (sd + 1e-6)) AS value_ewm_z,
       above AS value_ewm_above,
       CAST(sum(above) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS value_ewm_surges,
       SNAP12(abs(prev - mu) / (sd + 1e-6)) AS value_ewm_revert,
       SNAP(abs(prev - mu)) AS value_ewm_dev
FROM g
"""


@register("ewm_features", EWM_SQL)
def ewm_features(spark, sf):
    df = E.ewm(ev(spark, sf), ["value"], "user_id", EV_ORDER, span=21)
    df = df.select("event_id", "user_id", "value_ewm_mean", "value_ewm_std", "value_ewm_z",
                   "value_ewm_above", "value_ewm_surges", "value_ewm_revert", "value_ewm_dev")
    df = round_doubles(df, skip=("value_ewm_z", "value_ewm_revert"))
    return df.withColumns({c: snap(c, 12) for c in ("value_ewm_z", "value_ewm_revert")})


# W7/W8 with NULL gaps: the oracle replays the sequential update row by row
# (recursive CTE: old weight decays on every row, resets after an observation).
@register("ewm_features_gaps", f"""
WITH RECURSIVE b AS (
  SELECT event_id, user_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         lag(CASE WHEN event_id % 7 <> 0 THEN value END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS x
  FROM events),
rec AS (
  SELECT user_id, rn, event_id, x AS m, CAST(0.0 AS DOUBLE) AS cov, CAST(1.0 AS DOUBLE) AS sw2,
         CAST(1.0 AS DOUBLE) AS ow, CAST(1.0 AS DOUBLE) AS sw
  FROM b WHERE rn = 1
  UNION ALL
  SELECT b.user_id, b.rn, b.event_id,
         CASE WHEN rec.m IS NULL THEN b.x
              WHEN b.x IS NULL THEN rec.m
              ELSE (rec.ow * (1 - {ALPHA_SQL}) * rec.m + {ALPHA_SQL} * b.x) / (rec.ow * (1 - {ALPHA_SQL}) + {ALPHA_SQL}) END,
         CASE WHEN rec.m IS NULL THEN 0.0
              WHEN b.x IS NULL THEN rec.cov
              ELSE (rec.ow * (1 - {ALPHA_SQL}) * (rec.cov + (rec.m - ((rec.ow * (1 - {ALPHA_SQL}) * rec.m + {ALPHA_SQL} * b.x) / (rec.ow * (1 - {ALPHA_SQL}) + {ALPHA_SQL}))) ^ 2)
                    + {ALPHA_SQL} * (b.x - ((rec.ow * (1 - {ALPHA_SQL}) * rec.m + {ALPHA_SQL} * b.x) / (rec.ow * (1 - {ALPHA_SQL}) + {ALPHA_SQL}))) ^ 2)
                   / (rec.ow * (1 - {ALPHA_SQL}) + {ALPHA_SQL}) END,
         CASE WHEN rec.m IS NULL THEN 1.0
              WHEN b.x IS NULL THEN rec.sw2 * (1 - {ALPHA_SQL}) ^ 2
              ELSE (rec.sw2 * (1 - {ALPHA_SQL}) ^ 2 + {ALPHA_SQL} ^ 2) / (rec.ow * (1 - {ALPHA_SQL}) + {ALPHA_SQL}) ^ 2 END,
         CASE WHEN rec.m IS NULL THEN 1.0
              WHEN b.x IS NULL THEN rec.ow * (1 - {ALPHA_SQL})
              ELSE 1.0 END,
         CASE WHEN rec.m IS NULL THEN 1.0
              WHEN b.x IS NULL THEN rec.sw * (1 - {ALPHA_SQL})
              ELSE 1.0 END
  FROM rec JOIN b ON b.user_id = rec.user_id AND b.rn = rec.rn + 1)
SELECT event_id, user_id,
       SNAP(m) AS value_ewm_mean,
       SNAP(CASE WHEN m IS NOT NULL AND sw * sw - sw2 > 1e-9 * sw * sw
                 THEN sqrt(greatest(cov * sw * sw / (sw * sw - sw2), 0)) END) AS value_ewm_std
FROM rec
""")
def ewm_features_gaps(spark, sf):
    df = E.ewm(ev_gaps(spark, sf), ["value"], "user_id", EV_ORDER, span=21)
    return round_doubles(df.select("event_id", "user_id", "value_ewm_mean", "value_ewm_std"))


# W12 delta and W25 interactions ------------------------------------------------------
@register("delta_interactions", """
WITH f AS (
  SELECT event_id, user_id,
         lag(value) OVER w1 AS lag1,
         avg(value) OVER w AS em,
         stddev_samp(value) OVER w AS es,
         CASE WHEN count(value) OVER w5 = 5 THEN avg(value) OVER w5 END AS rm
  FROM events
  WINDOW w1 AS (PARTITION BY user_id ORDER BY ts, event_id),
         w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w5 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
SELECT event_id, user_id,
       SNAP(lag1 - em) AS value_delta,
       SNAP(em * rm) AS value_exp_mean_x_value_roll_mean,
       SNAP(lag1 * es) AS value_lag1_x_value_exp_std
FROM f
""")
def delta_interactions(spark, sf):
    df = ev(spark, sf)
    df = W.lags(df, ["value"], "user_id", EV_ORDER, ks=(1,))
    df = W.expanding(df, ["value"], "user_id", EV_ORDER)
    df = W.rolling(df, ["value"], "user_id", EV_ORDER)
    df = W.delta(df, ["value"])
    pairs = [("value_exp_mean", "value_roll_mean"), ("value_lag1", "value_exp_std"),
             ("value_exp_mean", "value_roll_mean"), ("value_lag1", "absent_column")]
    df = W.interactions(df, pairs)
    return round_doubles(df.select("event_id", "user_id", "value_delta", "value_exp_mean_x_value_roll_mean",
                                   "value_lag1_x_value_exp_std"))


# W13 EWM inside (entity, context), ranked per (date, context) --------------------------
CONTEXTS = ("click", "error", "purchase", "signup", "view")


@register("ewm_by_context", f"""
WITH r AS (
  SELECT event_id, user_id, event_type, ts, ts::date AS d, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events),
p AS (
  SELECT a.event_id, sum(CASE WHEN b.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
                              ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - b.rn) END * b.value) AS mu
  FROM r a JOIN r b ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.rn < a.rn
  GROUP BY a.event_id),
f AS (SELECT r.event_id, r.event_type, r.d, p.mu FROM r LEFT JOIN p USING (event_id)),
k AS (
  SELECT a.event_id,
         (count(*) FILTER (WHERE b.mu < a.mu) + (count(*) FILTER (WHERE b.mu = a.mu) + 1) / 2.0) / count(b.mu) AS pr
  FROM f a JOIN f b ON a.d = b.d AND a.event_type = b.event_type
  WHERE a.mu IS NOT NULL GROUP BY a.event_id)
SELECT e.event_id, e.event_type,
       {", ".join(f"CASE WHEN e.event_type = '{c}' THEN SNAP(f.mu) END AS value_ewm_mean_{c}, "
                  f"CASE WHEN e.event_type = '{c}' THEN SNAP(k.pr) END AS value_ewm_mean_{c}_prank" for c in CONTEXTS)}
FROM events e LEFT JOIN f USING (event_id) LEFT JOIN k USING (event_id)
""")
def ewm_by_context(spark, sf):
    out = E.ewm_by_context(ev(spark, sf), ["value"], "user_id", EV_ORDER, "event_type", CONTEXTS, span=21, date="d")
    return round_doubles(out.select("event_id", "event_type", *[f"value_ewm_mean_{c}{s}" for c in CONTEXTS for s in ("", "_prank")]))


# W14 expanding OLS slope ---------------------------------------------------------------
@register("trend_slope", """
WITH b AS (
  SELECT event_id, user_id, ts,
         lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
f AS (
  SELECT event_id, user_id, rn,
         regr_slope(prev, rn) OVER w AS s,
         count(prev) OVER w AS n,
         max(prev) OVER w AS hi, min(prev) OVER w AS lo,
         first_value(prev IGNORE NULLS) OVER w AS y0
  FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id,
       SNAP(CASE WHEN rn >= 21 AND n >= 3 AND greatest(hi - y0, y0 - lo) > 1e-8 + 1e-5 * abs(y0) THEN s END) AS value_slope
FROM f
""")
def trend_slope(spark, sf):
    df = W.trend_slope(ev(spark, sf), ["value"], "user_id", EV_ORDER, min_rows=21)
    return round_doubles(df.select("event_id", "user_id", "value_slope"))


# W15 hot/cold flags and streaks ---------------------------------------------------------
@register("streaks", """
WITH f AS (
  SELECT event_id, user_id, ts, value,
         avg(value) OVER w AS m, stddev_samp(value) OVER w AS s
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT *, coalesce(CASE WHEN value >= m + s THEN 1 ELSE 0 END, 0) AS hot,
            coalesce(CASE WHEN value < m - s THEN 1 ELSE 0 END, 0) AS cold FROM f),
h AS (
  SELECT *, coalesce(lag(hot) OVER w, 0) AS ph, coalesce(lag(cold) OVER w, 0) AS pc,
         row_number() OVER w AS rn
  FROM g WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (  -- islands: rows with a previous flag of 1 share rn - (running count of those rows)
  SELECT *, rn - sum(ph) OVER w AS gh, rn - sum(pc) OVER w AS gc
  FROM h WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, hot, cold,
       CAST(sum(ph) OVER (PARTITION BY user_id, gh ORDER BY ts, event_id) AS INTEGER) AS hot_streak,
       CAST(sum(pc) OVER (PARTITION BY user_id, gc ORDER BY ts, event_id) AS INTEGER) AS cold_streak
FROM i
""")
def streaks(spark, sf):
    df = W.expanding(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    df = W.hot_cold_flags(df, "value", "value_exp_mean", "value_exp_std", "hot", "cold")
    df = W.streak_before(df, "hot", "user_id", EV_ORDER, "hot_streak")
    df = W.streak_before(df, "cold", "user_id", EV_ORDER, "cold_streak")
    return df.select("event_id", "user_id", "hot", "cold", "hot_streak", "cold_streak")


# W16 rest days ----------------------------------------------------------------------------
@register("rest_days", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate::date AS d, year(o_orderdate) AS season FROM orders)
SELECT o_orderkey, o_custkey,
       CAST(date_diff('day', lag(d) OVER w, d) AS INTEGER) AS rest_days,
       CASE WHEN date_diff('day', lag(d) OVER w, d) = 1 THEN 1 ELSE 0 END AS back_to_back
FROM o WINDOW w AS (PARTITION BY o_custkey, season ORDER BY d, o_orderkey)
""")
def rest_days(spark, sf):
    df = orders_frame(spark, sf, customer=False)
    df = W.rest_days(df, ["o_custkey", "season"], "o_orderdate", OR_ORDER)
    return df.select("o_orderkey", "o_custkey", "rest_days", "back_to_back")


# W17 distinct active days in the trailing 7 ---------------------------------------------
@register("active_days_7", """
WITH dd AS (SELECT DISTINCT user_id, ts::date AS d FROM events),
c AS (
  SELECT a.user_id, a.d, count(*) AS n
  FROM dd a JOIN dd b ON a.user_id = b.user_id AND b.d > a.d - INTERVAL 7 DAY AND b.d <= a.d
  GROUP BY a.user_id, a.d)
SELECT e.event_id, e.user_id, c.n AS n_last_days
FROM events e JOIN c ON e.user_id = c.user_id AND e.ts::date = c.d
""")
def active_days_7(spark, sf):
    df = W.count_last_days(ev(spark, sf), "user_id", "d", days=7)
    return df.select("event_id", "user_id", "n_last_days")


# W18 cumulative record at event grain -------------------------------------------------------
@register("cumulative_record", """
WITH o AS (
  SELECT o.o_orderkey, c.c_mktsegment, year(o.o_orderdate) AS season, o.o_orderdate, o.o_orderstatus = 'F' AS win
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey, c_mktsegment,
       CAST(sum(CAST(win AS INTEGER)) OVER w AS BIGINT) AS cum_wins,
       CAST(sum(CAST(NOT win AS INTEGER)) OVER w AS BIGINT) AS cum_losses,
       SNAP(sum(CAST(win AS INTEGER)) OVER w / count(*) OVER w) AS cum_win_pct
FROM o WINDOW w AS (PARTITION BY c_mktsegment, season ORDER BY o_orderdate, o_orderkey
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def cumulative_record(spark, sf):
    df = orders_frame(spark, sf).withColumn("win", F.col("o_orderstatus") == "F")
    df = W.cumulative_record(df, ["c_mktsegment", "season"], OR_ORDER, "win")
    return round_doubles(df.select("o_orderkey", "c_mktsegment", "cum_wins", "cum_losses", "cum_win_pct"))


# W21 rolling sum of the previous 5 deduplicated dates -------------------------------------
@register("rolling_sum_prev", """
WITH d AS (
  SELECT c.c_mktsegment, CAST(year(o.o_orderdate) AS INTEGER) AS season, o.o_orderdate::date AS d,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS DOUBLE) AS n_urgent
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY ALL)
SELECT c_mktsegment, season, d, n_urgent,
       CASE WHEN count(n_urgent) OVER w = 5 THEN sum(n_urgent) OVER w END AS n_urgent_sum_prev5
FROM d WINDOW w AS (PARTITION BY c_mktsegment, season ORDER BY d ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
""")
def rolling_sum_prev(spark, sf):
    from tempolith.operators.aggs import daily_sum
    df = orders_frame(spark, sf).withColumn("n_urgent", (F.col("o_orderpriority") == "1-URGENT").cast("double"))
    daily = daily_sum(df.withColumnRenamed("o_orderdate", "d"), ["c_mktsegment", "season", "d"], ["n_urgent"])
    out = W.rolling_sum_prev(daily, ["n_urgent"], ["c_mktsegment", "season"], ["d"], n=5)
    return out.select("c_mktsegment", "season", "d", "n_urgent", "n_urgent_sum_prev5")


# W19 allowed EWM per (opponent, season, date), W20 allowed ratio -------------------------
def _ewm_daily_sql(table_sql: str, keys: str, val: str, out: str) -> str:
    """Closed-form EWM of the previous daily value as a weighted self-join."""
    return f"""
{out}_r AS (SELECT {keys}, d, {val} AS v,
                   row_number() OVER (PARTITION BY {keys} ORDER BY d) AS rn FROM {table_sql}),
{out} AS (
  SELECT a.d, {', '.join('a.' + k.strip() for k in keys.split(','))},
         sum(CASE WHEN b.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
                  ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - b.rn) END * b.v) AS {out}
  FROM {out}_r a JOIN {out}_r b ON {' AND '.join(f'a.{k.strip()} = b.{k.strip()}' for k in keys.split(','))} AND b.rn < a.rn
  GROUP BY ALL)"""


_OR_DAILY = """daily AS (
  SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderdate::date AS d,
         coalesce(sum(o_totalprice), 0) AS price
  FROM orders GROUP BY ALL)"""

@register("allowed_ewm", f"""
WITH {_OR_DAILY},
{_ewm_daily_sql('daily', 'o_orderpriority, season', 'price', 'e')},
f AS (SELECT d.o_orderpriority, d.season, d.d, SNAP12(e.e) AS allowed_price_ewm
      FROM daily d LEFT JOIN e USING (o_orderpriority, season, d)),
k AS (
  SELECT a.o_orderpriority, a.season, a.d,
         (count(*) FILTER (WHERE b.allowed_price_ewm < a.allowed_price_ewm)
          + (count(*) FILTER (WHERE b.allowed_price_ewm = a.allowed_price_ewm) + 1) / 2.0) / count(b.allowed_price_ewm) AS pr
  FROM f a JOIN f b ON a.d = b.d WHERE a.allowed_price_ewm IS NOT NULL GROUP BY ALL)
SELECT o.o_orderkey, f.allowed_price_ewm, SNAP(k.pr) AS allowed_price_ewm_prank
FROM orders o
LEFT JOIN f ON o.o_orderpriority = f.o_orderpriority AND year(o.o_orderdate) = f.season AND o.o_orderdate::date = f.d
LEFT JOIN k ON o.o_orderpriority = k.o_orderpriority AND year(o.o_orderdate) = k.season AND o.o_orderdate::date = k.d
""")
def allowed_ewm(spark, sf):
    o = orders_frame(spark, sf, customer=False).withColumnRenamed("o_totalprice", "price")
    keys = ["o_orderpriority", "season", "o_orderdate"]
    daily = E.allowed(o, ["o_orderpriority", "season"], "o_orderdate", ["price"], span=21)
    daily = daily.withColumn("allowed_price_ewm", snap("allowed_price_ewm", 12))
    daily = daily.withColumn("allowed_price_ewm_prank", snap(W.pct_rank_expr("allowed_price_ewm", "o_orderdate")))
    out = o.select("o_orderkey", *keys).join(daily, keys, "left")
    return out.select("o_orderkey", "allowed_price_ewm", "allowed_price_ewm_prank")


_LI_DAILY = """daily AS (
  SELECT o.o_orderpriority, CAST(year(o.o_orderdate) AS INTEGER) AS season, o.o_orderdate::date AS d,
         coalesce(sum(l.l_extendedprice * l.l_discount), 0) AS disc,
         coalesce(sum(l.l_extendedprice), 0) AS gross
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY ALL)"""

@register("allowed_ratio", f"""
WITH {_LI_DAILY},
{_ewm_daily_sql('daily', 'o_orderpriority, season', 'disc', 'em')},
{_ewm_daily_sql('daily', 'o_orderpriority, season', 'gross', 'ea')},
f AS (SELECT d.o_orderpriority, d.season, d.d, SNAP(em.em / nullif(ea.ea, 0)) AS disc_rate_ewm
      FROM daily d LEFT JOIN em USING (o_orderpriority, season, d) LEFT JOIN ea USING (o_orderpriority, season, d)),
k AS (
  SELECT a.o_orderpriority, a.season, a.d,
         (count(*) FILTER (WHERE b.disc_rate_ewm < a.disc_rate_ewm)
          + (count(*) FILTER (WHERE b.disc_rate_ewm = a.disc_rate_ewm) + 1) / 2.0) / count(b.disc_rate_ewm) AS pr
  FROM f a JOIN f b ON a.d = b.d WHERE a.disc_rate_ewm IS NOT NULL GROUP BY ALL)
SELECT f.o_orderpriority, f.season, f.d, f.disc_rate_ewm, SNAP(k.pr) AS disc_rate_ewm_prank
FROM f LEFT JOIN k USING (o_orderpriority, season, d)
""")
def allowed_ratio(spark, sf):
    o = orders_frame(spark, sf, customer=False).select("o_orderkey", "o_orderpriority", "season", F.col("o_orderdate").alias("d"))
    li = table_li(spark, sf)
    j = li.join(o, li.l_orderkey == o.o_orderkey).withColumns({
        "disc": F.col("l_extendedprice") * F.col("l_discount"), "gross": F.col("l_extendedprice")})
    daily = E.allowed_ratio(j, ["o_orderpriority", "season"], "d", [("disc", "gross", "disc_rate_ewm")])
    daily = daily.withColumn("disc_rate_ewm", snap("disc_rate_ewm"))
    daily = daily.withColumn("disc_rate_ewm_prank", snap(W.pct_rank_expr("disc_rate_ewm", "d")))
    return daily.select("o_orderpriority", "season", "d", "disc_rate_ewm", "disc_rate_ewm_prank")


def table_li(spark, sf):
    from tempolith.sources.tables import table
    return table(spark, sf, "lineitem")
