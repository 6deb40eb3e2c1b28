"""End-to-end job queries (P1-P9) over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tempolith.operators import filters as B
from tempolith.operators import intervals as IV
from tempolith.operators import joins as C
from tempolith.operators import uncertainty as U
from tempolith.plans import jobs as J
from tempolith.plans.bindings import ntz, EV_ORDER, ev, orders_frame, round_doubles, snap
from tempolith.plans.catalog import register
from tempolith.plans.q_intervals import CH_SIZE, _CH_SQL, ch_parts
from tempolith.plans.q_prep import _EVAL_SQL, _draw_summary
from tempolith.session import cut_lineage, scratch_path
from tempolith.sources.tables import table

ALPHA_SQL = "(2.0/22.0)"


# P4 flagship: the full feature build on the events frame -------------------------------------------
P4_COLS = ["event_id", "user_id", "value_lag1", "value_lag2", "value_exp_mean", "value_exp_std",
           "value_exp_max", "value_exp_min", "value_roll_mean", "value_roll_std", "value_roll_mad",
           "value_roll_trend", "value_ewm_mean", "value_ewm_std", "value_ewm_surges", "value_delta",
           "n_last_7d", "value_slope", "rest_days", "back_to_back", "hot_streak", "cold_streak",
           "value_ewm_mean_x_value_exp_mean", "value_roll_max", "value_roll_min", "value_ewm_above", "value_ewm_dev",
           "value_ewm_mean_click", "value_ewm_mean_view",
           "value_exp_mean_prank", "value_roll_mean_prank", "value_ewm_mean_prank", "value_slope_prank",
           "value_ewm_mean_click_prank", "value_ewm_mean_view_prank", "value_ewm_z", "value_ewm_revert"]
_RANKED = {"em": "value_exp_mean_prank", "rm": "value_roll_mean_prank", "mu": "value_ewm_mean_prank", "sl": "value_slope_prank",
           "clk": "value_ewm_mean_click_prank", "vw": "value_ewm_mean_view_prank"}
_SLOPE = "CASE WHEN rn >= 21 AND ns >= 3 AND greatest(hi - y0, y0 - lo) > 1e-8 + 1e-5 * abs(y0) THEN s END"
# ranks count smaller and equal values of the day, rounded so that rounding noise does not part equal ones
_RANK_SQL = f"""gs AS (SELECT g.event_id, d, SNAP(em) AS em, SNAP(rm) AS rm, SNAP(g.mu) AS mu, SNAP({_SLOPE}) AS sl,
             SNAP(CASE WHEN cx.event_type = 'click' THEN cx.mu END) AS clk, SNAP(CASE WHEN cx.event_type = 'view' THEN cx.mu END) AS vw
      FROM g LEFT JOIN cx USING (event_id)),""" + ", ".join(f"""
k_{c} AS (SELECT a.event_id, (count(*) FILTER (WHERE b.{c} < a.{c}) + (count(*) FILTER (WHERE b.{c} = a.{c}) + 1) / 2.0) / count(b.{c}) AS pr
         FROM gs a JOIN gs b ON a.d = b.d WHERE a.{c} IS NOT NULL GROUP BY a.event_id)""" for c in _RANKED)


def player_feature_frame(spark, sf):
    e = ev(spark, sf).withColumn("season", F.year("ts"))
    return J.feature_build(e, "user_id", EV_ORDER, "d", ["value"], season="season", context="event_type",
                           context_values=("click", "view"), span=21, roll=5, slope_min_rows=21,
                           hot_metric="value", rank_bits=20,
                           interaction_pairs=[("value_ewm_mean", "value_exp_mean")])


@register("player_features", f"""
WITH r AS (
  SELECT event_id, user_id, ts, ts::date AS d, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
p AS (
  SELECT a.event_id, b.value AS x,
         CASE WHEN b.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
              ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - b.rn) END AS wt
  FROM r a JOIN r b ON a.user_id = b.user_id AND b.rn < a.rn),
m AS (SELECT event_id, sum(wt * x) AS mu, sum(wt * wt) AS w2 FROM p GROUP BY event_id),
v AS (SELECT p.event_id, sum(p.wt * (p.x - m.mu) ^ 2) AS cov FROM p JOIN m USING (event_id) GROUP BY p.event_id),
f AS (
  SELECT r.*, m.mu, CASE WHEN 1 - m.w2 > 1e-9 THEN sqrt(v.cov / (1 - m.w2)) END AS sd,
         lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2,
         avg(value) OVER wx AS em, stddev_samp(value) OVER wx AS es, max(value) OVER wx AS emax, min(value) OVER wx AS emin,
         lag(value, 5) OVER w AS x0, lag(value, 4) OVER w AS x1, lag(value, 3) OVER w AS x2, lag(value, 2) OVER w AS x3,
         lag(value, 1) OVER w AS x4,
         date_diff('day', lag(ts::date) OVER w, ts::date) AS rest
  FROM r LEFT JOIN m USING (event_id) LEFT JOIN v USING (event_id)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
         wx AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT *,
         CASE WHEN x0 IS NOT NULL THEN (x0 + x1 + x2 + x3 + x4) / 5.0 END AS rm,
         coalesce(CASE WHEN lag1 > mu THEN 1 ELSE 0 END, 0) AS above,
         coalesce(CASE WHEN value >= mu + sd THEN 1 ELSE 0 END, 0) AS hot,
         coalesce(CASE WHEN value < mu - sd THEN 1 ELSE 0 END, 0) AS cold,
         regr_slope(lag1, rn) OVER wr AS s, count(lag1) OVER wr AS ns, max(lag1) OVER wr AS hi, min(lag1) OVER wr AS lo,
         first_value(lag1 IGNORE NULLS) OVER wr AS y0
  FROM f WINDOW wr AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (
  SELECT *, coalesce(lag(hot) OVER w, 0) AS ph, coalesce(lag(cold) OVER w, 0) AS pc,
         sum(above) OVER w AS surges
  FROM g WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, rn - sum(ph) OVER w AS gh, rn - sum(pc) OVER w AS gc
      FROM h WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
dd AS (SELECT DISTINCT user_id, ts::date AS d FROM events),
c7 AS (SELECT a.user_id, a.d, count(*) AS n FROM dd a JOIN dd b
       ON a.user_id = b.user_id AND b.d > a.d - INTERVAL 7 DAY AND b.d <= a.d GROUP BY ALL),
cr AS (SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events),
cx AS (SELECT a.event_id, a.event_type, sum(CASE WHEN b.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
                              ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - b.rn) END * b.value) AS mu
       FROM cr a JOIN cr b ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.rn < a.rn GROUP BY ALL),
{_RANK_SQL}
SELECT i.event_id AS event_id, i.user_id AS user_id, SNAP(lag1) AS value_lag1, SNAP(lag2) AS value_lag2,
       SNAP(em) AS value_exp_mean, SNAP(es) AS value_exp_std, SNAP(emax) AS value_exp_max, SNAP(emin) AS value_exp_min,
       SNAP(rm) AS value_roll_mean,
       SNAP(CASE WHEN x0 IS NOT NULL THEN sqrt(((x0-rm)^2 + (x1-rm)^2 + (x2-rm)^2 + (x3-rm)^2 + (x4-rm)^2) / 4.0) END) AS value_roll_std,
       SNAP(CASE WHEN x0 IS NOT NULL THEN (abs(x0-rm) + abs(x1-rm) + abs(x2-rm) + abs(x3-rm) + abs(x4-rm)) / 5.0 END) AS value_roll_mad,
       SNAP(CASE WHEN x0 IS NOT NULL THEN (-2*x0 - x1 + x3 + 2*x4) / 10.0 END) AS value_roll_trend,
       SNAP(mu) AS value_ewm_mean, SNAP(sd) AS value_ewm_std, CAST(surges AS BIGINT) AS value_ewm_surges,
       SNAP(lag1 - em) AS value_delta, c7.n AS n_last_7d,
       SNAP({_SLOPE}) AS value_slope,
       CAST(rest AS INTEGER) AS rest_days,
       CAST(sum(ph) OVER (PARTITION BY i.user_id, gh ORDER BY ts, i.event_id) AS INTEGER) AS hot_streak,
       CAST(sum(pc) OVER (PARTITION BY i.user_id, gc ORDER BY ts, i.event_id) AS INTEGER) AS cold_streak,
       SNAP12(mu * em) AS value_ewm_mean_x_value_exp_mean,
       CASE WHEN rest = 1 THEN 1 ELSE 0 END AS back_to_back,
       SNAP(CASE WHEN x0 IS NOT NULL THEN greatest(x0, x1, x2, x3, x4) END) AS value_roll_max,
       SNAP(CASE WHEN x0 IS NOT NULL THEN least(x0, x1, x2, x3, x4) END) AS value_roll_min,
       above AS value_ewm_above, SNAP(abs(lag1 - mu)) AS value_ewm_dev,
       SNAP((SELECT cx.mu FROM cx WHERE cx.event_id = i.event_id AND cx.event_type = 'click')) AS value_ewm_mean_click,
       SNAP((SELECT cx.mu FROM cx WHERE cx.event_id = i.event_id AND cx.event_type = 'view')) AS value_ewm_mean_view,
       {", ".join(f"SNAP(k_{c}.pr) AS {name}" for c, name in _RANKED.items())},
       SNAP((lag1 - mu) / (sd + 1e-6)) AS value_ewm_z, SNAP(abs(lag1 - mu) / (sd + 1e-6)) AS value_ewm_revert
FROM i JOIN c7 ON i.user_id = c7.user_id AND i.d = c7.d
{" ".join(f"LEFT JOIN k_{c} ON k_{c}.event_id = i.event_id" for c in _RANKED)}
""")
def player_features(spark, sf):
    df = player_feature_frame(spark, sf).select(*P4_COLS)
    df = round_doubles(df, skip=("value_ewm_mean_x_value_exp_mean",))
    return df.withColumn("value_ewm_mean_x_value_exp_mean", snap("value_ewm_mean_x_value_exp_mean", 12))


# P1 availability consolidation ------------------------------------------------------------------
def availability_sources(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # read by three sources: joined and written once
    j = cut_lineage(o.join(c, o.o_custkey == c.c_custkey).withColumn("d", F.to_date("o_orderdate")))
    digits = F.substring("c_name", 10, 64)
    pri = F.substring("o_orderpriority", 1, 1).cast("int")
    status = (F.when(pri == 1, "Out").when(pri == 2, "Out For Season").when(pri == 3, "Questionable")
              .otherwise("Available"))
    a = j.filter(F.col("o_orderkey") % 3 == 0).select(
        F.concat(digits, F.lit(", Customer")).alias("PLAYER"), F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("TEAM"),
        F.date_format("d", "M/d/yyyy").alias("DATE"), status.alias("STATUS"),
        F.concat(F.lit("status "), "o_orderstatus").alias("REASON"))
    b = j.filter(F.col("o_orderkey") % 3 == 1).select(
        F.concat(digits, F.lit(", Customer")).alias("PLAYER"), F.col("c_mktsegment").alias("TEAM"),
        F.date_format("d", "yyyy-MM-dd").alias("DATE"), status.alias("STATUS"))
    desc = (F.when(pri == 1, F.lit("Out (knee) - day to day"))
            .when(pri == 2, F.concat(F.lit("out for season ("), "o_orderstatus", F.lit(" issue) - x")))
            .otherwise(F.lit("Probable (rest)")))
    cc = j.filter(F.col("o_orderkey") % 3 == 2).select(
        F.concat(F.lit("Cústomer "), digits).alias("player"), F.col("c_mktsegment").alias("team"),
        F.date_format("d", "EEE, MMM d, yyyy").alias("updated"), desc.alias("description"))
    return J.prep_listing(a, "A"), J.prep_listing(b, "B"), J.prep_report(cc, "C")


_AVAIL_SQL = """
o AS (SELECT o.o_orderkey, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS pri, o.o_orderstatus,
             o.o_orderdate::date AS date, c.c_mktsegment AS team, substr(c.c_name, 10) AS digits
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
s AS (SELECT *, CASE pri WHEN 1 THEN 'Out' WHEN 2 THEN 'Out For Season' WHEN 3 THEN 'Questionable' ELSE 'Available' END AS st FROM o),
u AS (
  SELECT DISTINCT * FROM (
    SELECT team, date, digits || ', Customer' AS person, 'Customer ' || digits AS key, st AS status,
           'status ' || o_orderstatus AS reason, 'A' AS source FROM s WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT team, date, digits || ', Customer', 'Customer ' || digits, st, NULL, 'B' FROM s WHERE o_orderkey % 3 = 1
    UNION ALL
    SELECT team, date, 'Cústomer ' || digits, 'Customer ' || digits,
           CASE WHEN pri IN (1, 2) THEN 'Out' ELSE 'Probable' END,
           CASE pri WHEN 1 THEN 'knee' WHEN 2 THEN o_orderstatus || ' issue' ELSE 'rest' END, 'C'
    FROM s WHERE o_orderkey % 3 = 2)
  WHERE lower(status) LIKE 'out%'),
av AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY team, date, key ORDER BY source, reason NULLS LAST) = 1)"""


@register("availability", f"""
WITH {_AVAIL_SQL}
SELECT team, date, person, key, status, reason, source FROM av
""")
def availability(spark, sf):
    a, b, c = availability_sources(spark, sf)
    return J.consolidate_availability([a, b, c], "out", priority=["A", "B", "C"])


# P1 what a listing leaves out, by reason ----------------------------------------------------------------------------
@register("listing_rejects", """
WITH l AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Customer ' || o_custkey END AS player, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS team,
                  CASE o_orderkey % 7 WHEN 0 THEN 'tomorrow' WHEN 1 THEN ' ' WHEN 2 THEN NULL WHEN 3 THEN '31/31/2024' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
SELECT CASE WHEN d IS NULL OR trim(d) = '' THEN 'no date' WHEN d IN ('tomorrow', '31/31/2024') THEN 'date not understood' WHEN team IS NULL THEN 'no team' ELSE 'no person' END AS reason,
       CASE WHEN d IN ('tomorrow', '31/31/2024') THEN d END AS text, count(*) AS n
FROM l WHERE d IS NULL OR trim(d) = '' OR d IN ('tomorrow', '31/31/2024') OR team IS NULL OR player IS NULL GROUP BY ALL
""")
def listing_rejects(spark, sf):
    key = F.col("o_orderkey")
    day = (F.when(key % 7 == 0, "tomorrow").when(key % 7 == 1, " ").when(key % 7 == 2, None).when(key % 7 == 3, "31/31/2024")
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    listing = table(spark, sf, "orders").select(F.when(key % 11 != 0, F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))).alias("PLAYER"),
                                                F.when(key % 13 != 0, F.col("o_orderpriority")).alias("TEAM"), day.alias("DATE"))
    return J.listing_rejects(listing)


# P2 key member unavailable flag ---------------------------------------------------------------
@register("key_member_out", f"""
WITH {_AVAIL_SQL},
r AS (SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment AS team, o.o_orderdate::date AS date,
             o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS starter
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
km AS (SELECT o_custkey FROM r GROUP BY 1 HAVING avg(CAST(starter AS INTEGER)) > 0.5),
outk AS (SELECT DISTINCT team, date FROM av WHERE CAST(substr(key, 10) AS BIGINT) IN (SELECT o_custkey FROM km))
SELECT r.o_orderkey, coalesce(k.team IS NOT NULL, false) AS key_member_out
FROM r LEFT JOIN outk k ON r.team = k.team AND r.date = k.date
""")
def key_member_out(spark, sf):
    a, b, c = availability_sources(spark, sf)
    av = J.consolidate_availability([a, b, c], "out", priority=["A", "B", "C"])
    av = av.withColumn("o_custkey", F.substring("key", 10, 64).cast("long"))
    rows = orders_frame(spark, sf).select("o_orderkey", "o_custkey", F.col("c_mktsegment").alias("team"),
                                          F.col("o_orderdate").alias("date"),
                                          F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("starter"))
    out = J.key_member_flag(rows, "o_custkey", "team", "date", "starter", av)
    return out.select("o_orderkey", "key_member_out")


# P3 feature-ready assembly ----------------------------------------------------------------------
@register("ready_rows", f"""
WITH {_AVAIL_SQL},
r AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, CAST(year(o.o_orderdate) AS INTEGER) AS season,
             c.c_mktsegment AS team, o.o_orderdate::date AS date, o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS starter
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
km AS (SELECT o_custkey FROM r GROUP BY 1 HAVING avg(CAST(starter AS INTEGER)) > 0.5),
outk AS (SELECT DISTINCT team, date FROM av WHERE CAST(substr(key, 10) AS BIGINT) IN (SELECT o_custkey FROM km)),
l AS (SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS n_parts, sum(l_discount * l_extendedprice) / sum(l_extendedprice) AS disc,
             max(l_extendedprice) AS top_price FROM lineitem GROUP BY 1),
j AS (SELECT r.*, l.qty, l.n_parts, l.disc, l.top_price, coalesce(outk.team IS NOT NULL, false) AS key_member_out
      FROM r LEFT JOIN l ON r.o_orderkey = l.l_orderkey LEFT JOIN outk ON outk.team = r.team AND outk.date = r.date
      WHERE l.qty IS NOT NULL AND r.o_orderstatus <> 'P' AND r.o_totalprice > 0),
m AS (SELECT * FROM j WHERE o_custkey IN (SELECT o_custkey FROM j GROUP BY 1 HAVING count(*) >= 10)),
q AS (SELECT m.* FROM m JOIN (SELECT o_custkey, season FROM m GROUP BY ALL HAVING avg(o_totalprice) >= 150000) k
      USING (o_custkey, season))
SELECT o_orderkey, o_custkey, season, SNAP(qty) AS qty, n_parts, SNAP(disc) AS disc_wmean, SNAP(top_price) AS top_price, key_member_out FROM q
WHERE o_custkey IN (SELECT o_custkey FROM q WHERE season = 2001)
""")
def ready_rows(spark, sf):
    o = orders_frame(spark, sf).withColumnsRenamed({"c_mktsegment": "team", "o_orderdate": "date"}).withColumns(
        {"pending": F.col("o_orderstatus") == "P", "starter": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")})
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_extendedprice", F.col("l_quantity").alias("qty"),
                                                F.col("l_extendedprice").alias("top_price"))
    av = J.consolidate_availability(availability_sources(spark, sf), "out", priority=["A", "B", "C"])
    av = av.select("team", "date", F.substring("key", 10, 64).cast("long").alias("o_custkey"))
    out = J.ready_rows(o, lines, "o_orderkey", "l_orderkey", "o_custkey", "season", "o_totalprice",
                       [F.col("top_price").desc()], ["top_price"], "qty", ("l_discount", "l_extendedprice"), ["c_nationkey"],
                       "pending", 10, 150000, 2001, av, "team", "date", "starter")
    return round_doubles(out.select("o_orderkey", "o_custkey", "season", "qty", "n_parts", F.col("l_discount_wmean").alias("disc_wmean"),
                                    "top_price", "key_member_out"))


# P5 interval reconstruction for new groups only --------------------------------------------------
@register("intervals_incremental", f"""
WITH {_CH_SQL}
SELECT grp, CAST(k AS INTEGER) AS k, start_ AS "start", end_ AS "end", lineup FROM lineups
""")
def intervals_incremental(spark, sf):
    e, changes, starters, spans = ch_parts(spark, sf)
    # the earlier run knew five groups, and of group 2 only a part of the log that was corrected since
    old = (F.col("grp") < 5) & ((F.col("grp") != 2) | (F.col("clk") < 19 * 24))
    earlier = changes.filter(old)
    existing = IV.active_intervals(earlier, starters.filter("grp < 5"), spans.filter("grp < 5"),
                                   "grp", "user_id", "clk", "is_in", size=CH_SIZE)
    path = scratch_path(spark, "intervals_existing")
    existing.write.mode("overwrite").parquet(path)          # the materialised earlier run
    existing = spark.read.parquet(path)
    out = J.intervals_incremental(existing, J.change_summary(earlier, "grp"), changes, starters, spans,
                                  "grp", "user_id", "clk", "is_in", CH_SIZE)
    return out.select("grp", "k", "start", "end", "lineup")


# D7 on/off totals kept incrementally: group 2's log was corrected, groups from 5 on are new ---------------------------------
def _register_on_off():
    from tempolith.plans.catalog import ORACLE
    from tempolith.plans.q_intervals import counted_intervals

    @register("on_off_incremental", ORACLE["on_off_split"])
    def on_off_incremental(spark, sf):
        e, changes, starters, spans = ch_parts(spark, sf)
        earlier = changes.filter((F.col("grp") < 5) & ((F.col("grp") != 2) | (F.col("clk") < 19 * 24)))
        before = counted_intervals(e.filter("grp < 5"), earlier, starters.filter("grp < 5"), spans.filter("grp < 5"))
        path = scratch_path(spark, "on_off_existing")
        IV.on_off(before, "grp", ["n_ev", "v"]).write.parquet(path)         # the materialised earlier run
        same = J.unchanged_groups(J.change_summary(earlier, "grp"), changes, "grp")
        out = J.on_off_incremental(spark.read.parquet(path), same, counted_intervals(e, changes, starters, spans), "grp", ["n_ev", "v"])
        return round_doubles(out.select("grp", "member", "n_on", "on_n_ev", "on_v", "off_n_ev", "off_v"))


_register_on_off()


# P5 + D7 as a store: an earlier run is kept by group, then every kind of change comes at once -------------------------------
def _changed_store(spark, sf):
    """The store after a run on earlier inputs and one on the present ones. Earlier, groups 8 and 9 were not there yet; group 2's
    log held a wrong row twice where it now holds the right one twice; group 3 lacked its last event, group 5 a starter;
    group 4's span ended sooner; and a group 99 has gone since."""
    from tempolith.sources.store import GroupStore
    e, changes, starters, spans = ch_parts(spark, sf)
    first = changes.filter("grp = 2").groupBy("grp").agg(F.min_by(F.struct("user_id", "clk", "is_in"), F.struct("clk", "user_id", "is_in")).alias("r"))
    twin = first.select("grp", "r.*")
    wrong = twin.withColumn("is_in", ~F.col("is_in"))
    last = e.filter("grp = 3").agg(F.max("event_id")).first()[0]
    gone = lambda df: df.unionByName(df.filter("grp = 0").withColumn("grp", F.lit(99).cast(df.schema["grp"].dataType)))
    known = F.col("grp") < 8
    right = changes.join(twin, changes.columns, "left_anti")
    earlier = {"changes": gone(right.filter(known)).unionByName(wrong).unionByName(wrong),
               "starters": gone(starters.filter(known & ~((F.col("grp") == 5) & (F.col("user_id") % 3 == 0)))),
               "spans": gone(spans.filter(known)).withColumn("end", F.when(F.col("grp") == 4, F.col("end") - 24).otherwise(F.col("end"))),
               "events": gone(e.filter(known & (F.col("event_id") != last)))}
    present = {"changes": right.unionByName(twin).unionByName(twin), "starters": starters, "spans": spans, "events": e}
    store = GroupStore(spark, scratch_path(spark, "interval_store"), "grp", buckets=16)
    for run in (earlier, present):
        rebuilt = J.update_interval_store(store, **run, member="user_id", clock="clk", is_in="is_in", size=CH_SIZE, bucket_width=24.0,
                                          counters={"n_ev": F.count(F.lit(1)), "v": F.sum("value")})
    return store, rebuilt


@register("store_intervals", f"""
WITH {_CH_SQL},
hit AS (SELECT l.grp, l.k, e.value FROM lineups l JOIN e ON e.grp = l.grp AND e.clk > l.start_ AND e.clk <= l.end_)
SELECT l.grp, CAST(l.k AS INTEGER) AS k, l.start_ AS "start", l.end_ AS "end", l.lineup, count(h.k) AS n_ev, SNAP(coalesce(sum(h.value), 0)) AS v,
       l.grp IN (2, 3, 4, 5, 8, 9) AS rebuilt
FROM lineups l LEFT JOIN hit h ON h.grp = l.grp AND h.k = l.k GROUP BY ALL
""")
def store_intervals(spark, sf):
    store, rebuilt = _changed_store(spark, sf)
    mark = rebuilt.withColumn("rebuilt", F.lit(True))
    out = store.table("intervals").join(mark, "grp", "left").withColumn("rebuilt", F.coalesce("rebuilt", F.lit(False)))
    return round_doubles(out.select("grp", "k", "start", "end", "lineup", "n_ev", "v", "rebuilt"))


def _register_store_on_off():
    from tempolith.plans.catalog import ORACLE

    @register("store_on_off", ORACLE["on_off_split"])
    def store_on_off(spark, sf):
        return round_doubles(_changed_store(spark, sf)[0].table("on_off").select("grp", "member", "n_on", "on_n_ev", "on_v", "off_n_ev", "off_v"))


_register_store_on_off()


# P6 upcoming slate: schedule x roster x latest row --------------------------------------------------
@register("upcoming_slate", """
WITH g AS (SELECT n_nationkey AS home, (n_nationkey + 1) % 25 AS away, n_regionkey AS week FROM nation),
s AS (SELECT week, home AS team, away AS opponent, 'home' AS side FROM g UNION ALL SELECT week, away, home, 'away' FROM g),
cur AS (SELECT c_nationkey AS team, c_custkey FROM customer WHERE c_nationkey NOT IN (3, 7)),
hist AS (SELECT c.c_nationkey AS team, c.c_custkey FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS seen FROM orders GROUP BY 1) s ON s.o_custkey = c.c_custkey
         WHERE c.c_nationkey NOT IN (SELECT DISTINCT team FROM cur)
         QUALIFY row_number() OVER (PARTITION BY c.c_nationkey ORDER BY s.seen DESC NULLS LAST, c.c_custkey) <= 18),
ros AS (SELECT * FROM cur UNION ALL SELECT * FROM hist),
lt AS (SELECT o_custkey AS c_custkey, o_orderkey AS last_order, o_totalprice AS last_price FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT s.week, s.team, s.opponent, s.side, r.c_custkey, lt.last_order, lt.last_price
FROM s JOIN ros r ON r.team = s.team LEFT JOIN lt ON lt.c_custkey = r.c_custkey
""")
def upcoming_slate(spark, sf):
    g = table(spark, sf, "nation").select(F.col("n_nationkey").alias("home"),
                                           ((F.col("n_nationkey") + 1) % 25).alias("away"),
                                           F.col("n_regionkey").alias("week"))
    o = table(spark, sf, "orders")
    cust = table(spark, sf, "customer").select(F.col("c_nationkey").alias("team"), "c_custkey")
    cur = cust.filter(~F.col("team").isin(3, 7))            # two teams have no current roster
    seen = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("seen"))
    history = cust.join(seen, "c_custkey", "left")
    from tempolith.operators.windows import latest
    lt = latest(o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"),
                         F.col("o_totalprice").alias("last_price"), "o_orderdate"),
                "c_custkey", ["o_orderdate", "last_order"]).drop("o_orderdate")
    out = J.upcoming_slate(g, "home", "away", cur, history, "team", 18,
                           [F.col("seen").desc_nulls_last(), F.col("c_custkey")], lt, "c_custkey")
    return out.select("week", "team", "opponent", "side", "c_custkey", "last_order", "last_price")


# P7 score, calibrate, clamp, keep eligible, next slate, dated sink -------------------------------------
@register("publish_scores", f"""
WITH {_EVAL_SQL},
dd AS (SELECT user_id, event_type AS target, max(ts::date) AS d FROM events GROUP BY ALL),
el AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'),
x AS (SELECT ivc.*, dd.d FROM ivc JOIN dd USING (user_id, target) WHERE user_id IN (SELECT user_id FROM el)),
pk AS (SELECT coalesce(min(d) FILTER (WHERE d >= DATE '2024-01-29'), max(d)) AS p FROM x)
SELECT user_id, target, SNAP(mu) AS mean_pred, SNAP(q10) AS q10, SNAP(q90) AS q90,
       SNAP(greatest(q90 - q10, 0)) AS pi80_width, DATE '2024-02-01' AS run_date
FROM x, pk WHERE x.d = pk.p
""")
def publish_scores(spark, sf):
    s = _draw_summary(spark, sf)
    e = table(spark, sf, "events")
    y = e.groupBy("user_id", F.col("event_type").alias("target")).agg(
        F.max_by("value", "event_id").alias("y"), F.max(F.to_date("ts")).alias("d"))
    j = s.join(y, ["user_id", "target"])
    qs = U.fit_quantile_scale(j, "target", "y", "q50", "q10", "q90")
    yp = e.groupBy(F.col("event_type").alias("target")).agg(F.avg("value").alias("y_mean")).withColumn(
        "y_scale", F.lit(1.0))
    eligible = e.filter(F.col("event_type") == "purchase").select("user_id")
    path = scratch_path(spark, "published")
    out = J.score_and_publish(j, qs, yp, eligible, "user_id", "d", dt.date(2024, 1, 29), path, dt.date(2024, 2, 1))
    return round_doubles(out.select("user_id", "target", "mean_pred", "q10", "q90", "pi80_width", "run_date"))


# P8 train / calibrate / evaluate (checked by tests: coverage after calibration, unique rows) ---------------------------
@register("train_evaluate")
def train_evaluate(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"), F.avg("l_discount").alias("disc"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"), "o_totalprice", "o_orderpriority", "o_orderstatus")
    o = o.join(lines, "o_orderkey", "left")
    prior = o.filter("season < 2000").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("prior"))
    return J.train_evaluate(o.join(prior, "o_custkey", "left"), "o_orderkey", "season", 2000, ["o_totalprice"], scratch_path(spark, "train_evaluate"), members=6, trees=2,
                            priors={"o_totalprice": "prior"}, numeric=["qty", "n_lines", "disc"], categorical=["o_orderpriority", "o_orderstatus"], index=["o_custkey"])


# P7 with everything fitted saved and loaded: preprocessing, ensemble, scales; all targets in the published layout ------------
# A linear fit is the same whatever the scale and sign of its feature, so SQL repeats it on the raw columns.
from tempolith.plans.q_prep import _POISSON, _U  # noqa: E402

_TARGETS = ("price", "urgent")


def _fit_sql(t):
    return f"""
b_{t} AS (SELECT m, (sum(w) * sum(w * x * {t}) - sum(w * x) * sum(w * {t})) / (sum(w) * sum(w * x * x) - sum(w * x) ^ 2) AS slope,
             sum(w * x) AS sx, sum(w * {t}) AS sy, sum(w) AS sw FROM w GROUP BY m),
c_{t} AS (SELECT m, slope, (sy - slope * sx) / sw AS icpt FROM b_{t}),
lv_{t} AS (SELECT m, avg(({t} - icpt - slope * x) ^ 2) AS v FROM fit, c_{t} GROUP BY m),
s_{t} AS (SELECT sl.row_, avg(icpt + slope * x) AS mu, stddev_pop(icpt + slope * x) AS se, sqrt(avg(v)) AS sa
          FROM sl, c_{t} JOIN lv_{t} USING (m) GROUP BY sl.row_)"""


@register("score_slate", f"""
WITH q AS (SELECT l_orderkey, sum(l_quantity) AS x FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS row_, o_orderdate, coalesce(q.x, 0) AS x, o_totalprice AS price, CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS urgent
      FROM orders LEFT JOIN q ON l_orderkey = o_orderkey),
fit AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01' AND ('0x' || substr(md5('42:' || row_), 1, 12))::BIGINT % 1048576 >= 524288),
sl AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
mm AS (SELECT CAST(m AS INTEGER) AS m FROM range(0, 6) t(m)),
wt AS (SELECT fit.*, m, {_U.format("'7:' || row_ || ':' || m")} AS u FROM fit, mm),
w AS (SELECT *, {_POISSON} AS w FROM wt),
{",".join(map(_fit_sql, _TARGETS))}
SELECT p.row_ AS o_orderkey, round(p.mu / 1000, 4) AS price_mean_pred, round(p.se / 1000, 4) AS price_std_epistemic,
       round(p.sa / 1000, 4) AS price_std_aleatoric, round(u.mu, 6) AS urgent_mean_pred,
       round(u.se, 6) AS urgent_std_epistemic, round(u.sa, 6) AS urgent_std_aleatoric
FROM s_price p JOIN s_urgent u USING (row_)
""")
def score_slate(spark, sf):
    qty = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("x"))
    o = table(spark, sf, "orders").join(qty, "o_orderkey", "left").select(
        "o_orderkey", "o_orderdate", F.coalesce("x", F.lit(0.0)).alias("x"), F.col("o_totalprice").alias("price"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"))
    first = F.lit("1999-01-01").cast("timestamp_ntz")
    path = scratch_path(spark, "artifacts")
    J.fit_artifacts(o.filter(F.col("o_orderdate") < first), "o_orderkey", _TARGETS, path, members=6, numeric=["x"])
    out = J.score_slate(o.filter(F.col("o_orderdate") >= first).select("o_orderkey", "x"), "o_orderkey", path, _TARGETS,
                        ["mean_pred", "std_epistemic", "std_aleatoric"], calibrated=False)
    return out.select("o_orderkey", *[F.round(F.col(f"{t}_{m}") / k, n).alias(f"{t}_{m}") for t, k, n in (("price", 1000, 4), ("urgent", 1, 6))
                                      for m in ("mean_pred", "std_epistemic", "std_aleatoric")])


# P7 as one job: eligible customers' next slate, priors dampened and blended, calibrated draws, all measures, dated sink -------
_P7_MEASURES = {"mean_pred": "greatest(mu, 0)", "q10": "greatest(a10, 0)", "q50": "greatest(a50, 0)", "q90": "greatest(a90, 0)", "std80_lower": "greatest(mu - 1.2815515655446004 * sp, 0)",
                "std80_upper": "mu + 1.2815515655446004 * sp", "pi80_width": "greatest(greatest(a90, 0) - greatest(a10, 0), 0)", "std_predictive": "sp", "std_epistemic": "se", "std_aleatoric": "sa"}


def _p7_target(t):
    return f"""
v_{t} AS (SELECT d.row_, d.m, d.mean, d.logvar, d.{t} AS y, d.cal, (CASE WHEN d.slate THEN d.r_{t} * d.w_{t} ELSE d.r_{t} END - mo.m_{t}) / mo.s_{t} AS prior
          FROM (SELECT * FROM d_{t}) d, mo),
h_own_{t} AS (SELECT row_, avg(mean) AS pred, any_value(y) AS y, any_value(prior) AS prior FROM v_{t} WHERE cal GROUP BY row_),
own_{t} AS (SELECT greatest(least(sum((y - prior) * (pred - prior)) / sum((pred - prior) ^ 2), 1), 0) AS own FROM h_own_{t} WHERE prior IS NOT NULL),
u_{t} AS (SELECT row_, cal, y, logvar, coalesce(own * mean + (1 - own) * prior, mean) AS mean,
                 {_U.format(f"'7:radius:' || row_ || ':{t}:' || m")} AS u, {_U.format(f"'7:angle:' || row_ || ':{t}:' || m")} AS v FROM v_{t}, own_{t}),
n_{t} AS (SELECT *, mean + exp(logvar / 2) * sqrt(-2 * ln(u)) * cos(2 * pi() * v) AS sample FROM u_{t}),
z_{t} AS (SELECT row_, any_value(cal) AS cal, any_value(y) AS y, avg(mean) AS mu, stddev_pop(mean) AS se, sqrt(avg(exp(logvar))) AS sa,
                 quantile_cont(sample, 0.1) AS q10, quantile_cont(sample, 0.5) AS q50, quantile_cont(sample, 0.9) AS q90 FROM n_{t} GROUP BY row_),
ss_{t} AS (SELECT arg_min(s, (abs(cov - 0.8), s)) AS s FROM (SELECT g.s, avg(CASE WHEN abs(y - mu) <= 1.2815515655446004 * sqrt(se ^ 2 + (g.s * sa) ^ 2) THEN 1.0 ELSE 0.0 END) AS cov
           FROM z_{t}, grid g WHERE cal GROUP BY g.s)),
qs_{t} AS (SELECT arg_min(s, (abs(cov - 0.8), s)) AS s FROM (SELECT g.s, avg(CASE WHEN y >= q50 + g.s * (q10 - q50) AND y <= q50 + g.s * (q90 - q50) THEN 1.0 ELSE 0.0 END) AS cov
           FROM z_{t}, grid g WHERE cal GROUP BY g.s)),
f_{t} AS (SELECT row_, mu * s_{t} + m_{t} AS mu, se * s_{t} AS se, sa * ss.s * s_{t} AS sa, sqrt(se ^ 2 + (sa * ss.s) ^ 2) * s_{t} AS sp, q50 * s_{t} + m_{t} AS a50,
                 (q50 + (q10 - q50) * qs.s) * s_{t} + m_{t} AS a10, (q50 + (q90 - q50) * qs.s) * s_{t} + m_{t} AS a90
          FROM z_{t}, ss_{t} ss, qs_{t} qs, mo WHERE NOT cal),
o_{t} AS (SELECT row_, {", ".join(f"{e} AS {t}_{m}" for m, e in _P7_MEASURES.items())} FROM f_{t})"""


# P8 with one feature, so that SQL can repeat the fit: two targets, blended with customers' earlier means, calibrated and not ----
def _register_train_evaluate():
    from tempolith.plans.q_prep import _GRID_SQL, _METRICS_SQL, _members_sql, _orders_xy

    def rows(t, cal):
        q, s = (("qs.s", "ss.s") if cal else ("1", "1"))
        return f"""SELECT '{t}' AS target, mu * s_{t} + m_{t} AS mu, se * s_{t} AS se, sa * {s} * s_{t} AS sa, sqrt(se ^ 2 + (sa * {s}) ^ 2) * s_{t} AS sp, q50 * s_{t} + m_{t} AS q50,
                 (q50 + (q10 - q50) * {q}) * s_{t} + m_{t} AS q10, (q50 + (q90 - q50) * {q}) * s_{t} + m_{t} AS q90, z_{t}.y * s_{t} + m_{t} AS y
          FROM z_{t} JOIN o USING (row_), ss_{t} ss, qs_{t} qs, mo WHERE o.slate"""

    metrics = " UNION ALL ".join(f"""SELECT * FROM (WITH ivc AS ({" UNION ALL ".join(rows(t, s == "cal") for t in _TARGETS)}) {_METRICS_SQL.format(suffix=s)})""" for s in ("cal", "uncal"))

    @register("train_evaluate_blend", f"""
WITH {_GRID_SQL}, q AS (SELECT l_orderkey, sum(l_quantity) AS x FROM lineitem GROUP BY 1),
o0 AS (SELECT o_orderkey AS row_, o_custkey, o_orderdate, coalesce(q.x, 0) / 100 AS x, o_totalprice / 100000 AS price,
              CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS urgent, o_orderdate < TIMESTAMP '1999-01-01' AS early FROM orders LEFT JOIN q ON l_orderkey = o_orderkey),
mo AS (SELECT avg(price) AS m_price, stddev_pop(price) AS s_price, avg(urgent) AS m_urgent, stddev_pop(urgent) AS s_urgent FROM o0 WHERE early),
pr AS (SELECT o_custkey, avg(price) AS r_price, avg(urgent) AS r_urgent FROM o0 WHERE early GROUP BY 1),
o AS (SELECT o0.row_, o0.o_custkey, o_orderdate, x, (price - m_price) / s_price AS price, (urgent - m_urgent) / s_urgent AS urgent, early,
             early AND ('0x' || substr(md5('42:' || o0.row_), 1, 12))::BIGINT % 1048576 < 524288 AS cal, NOT early AS slate, r_price, r_urgent, 1.0 AS w_price, 1.0 AS w_urgent
      FROM o0 LEFT JOIN pr USING (o_custkey), mo),
tr AS (SELECT * FROM o WHERE early AND NOT cal), mm AS (SELECT CAST(m AS INTEGER) AS m FROM range(0, 6) t(m)),
{_members_sql("price")}, {_members_sql("urgent")}, {_p7_target("price")}, {_p7_target("urgent")}
{metrics}
""")
    def train_evaluate_blend(spark, sf):
        o, early = _orders_xy(spark, sf)
        prior = o.filter(early).groupBy("o_custkey").agg(F.avg("price").alias("p_price"), F.avg("urgent").alias("p_urgent"))
        rows = o.join(prior, "o_custkey", "left").withColumn("season", F.year("o_orderdate"))
        return round_doubles(J.train_evaluate(rows, "o_orderkey", "season", 1999, list(_TARGETS), scratch_path(spark, "train_evaluate"), members=6,
                                              priors={t: f"p_{t}" for t in _TARGETS}, numeric=["x"]))


_register_train_evaluate()


def _register_publish_slate():
    from tempolith.plans.q_prep import _GRID_SQL, _members_sql, _orders_xy

    @register("publish_slate", f"""
WITH {_GRID_SQL}, q AS (SELECT l_orderkey, sum(l_quantity) AS x FROM lineitem GROUP BY 1),
o0 AS (SELECT o_orderkey AS row_, o_custkey, o_orderdate, coalesce(q.x, 0) / 100 AS x, o_totalprice / 100000 AS price,
              CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS urgent, o_orderdate < TIMESTAMP '1999-01-01' AS early FROM orders LEFT JOIN q ON l_orderkey = o_orderkey),
mo AS (SELECT avg(price) AS m_price, stddev_pop(price) AS s_price, avg(urgent) AS m_urgent, stddev_pop(urgent) AS s_urgent FROM o0 WHERE early),
pr AS (SELECT o_custkey, avg(price) AS r_price, avg(urgent) AS r_urgent, avg(x) AS lx, count(*) AS n,
              avg(price) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS l_price, avg(urgent) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS l_urgent,
              avg(x) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS rx FROM o0 WHERE early GROUP BY 1),
pw AS (SELECT *, CASE WHEN rx IS NOT NULL THEN greatest(least(rx / (lx + 1e-6), 1.0), 0.2) END AS mr FROM pr),
pd AS (SELECT *, {", ".join(f"CASE WHEN mr IS NOT NULL THEN least(mr, greatest(least(coalesce(CASE WHEN r_{t} <> 0 THEN l_{t} / r_{t} END, 1.0), 1.0), 0.2)) END AS w_{t}" for t in _TARGETS)} FROM pw),
sl AS (SELECT o0.row_, o0.o_orderdate::date AS d FROM o0 JOIN pr USING (o_custkey) WHERE NOT early AND pr.n >= 5),
nx AS (SELECT coalesce(min(d) FILTER (WHERE d >= DATE '1999-06-01'), max(d)) AS d FROM sl),
o AS (SELECT o0.row_, o0.o_custkey, o_orderdate, x, (price - m_price) / s_price AS price, (urgent - m_urgent) / s_urgent AS urgent, early,
             early AND ('0x' || substr(md5('42:' || o0.row_), 1, 12))::BIGINT % 1048576 < 524288 AS cal, NOT early AS slate, r_price, r_urgent, w_price, w_urgent
      FROM o0 LEFT JOIN pd USING (o_custkey), mo WHERE early OR o0.row_ IN (SELECT row_ FROM sl JOIN nx USING (d))),
tr AS (SELECT * FROM o WHERE early AND NOT cal), mm AS (SELECT CAST(m AS INTEGER) AS m FROM range(0, 6) t(m)),
{_members_sql("price")}, {_members_sql("urgent")}, {_p7_target("price")}, {_p7_target("urgent")}
SELECT o_price.row_ AS o_orderkey, o.o_custkey, o.o_orderdate::date AS d, {", ".join(f"SNAP12({t}_{m}) AS {t}_{m}" for t in _TARGETS for m in _P7_MEASURES)}, DATE '1999-06-01' AS run_date
FROM o_price JOIN o_urgent USING (row_) JOIN o USING (row_) WHERE o.slate
""")
    def publish_slate(spark, sf):
        o, early = _orders_xy(spark, sf)
        late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
        past = o.filter(early).groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), F.avg("price").alias("price_exp_mean"), F.avg("urgent").alias("urgent_exp_mean"), F.avg("x").alias("x_long"),
            F.avg(F.when(late, F.col("price"))).alias("price_ewm_mean"), F.avg(F.when(late, F.col("urgent"))).alias("urgent_ewm_mean"), F.avg(F.when(late, F.col("x"))).alias("x_recent"))
        rows = o.join(past.drop("n"), "o_custkey", "left").withColumn("d", F.to_date("o_orderdate"))
        priors = {t: f"{t}_exp_mean" for t in _TARGETS}
        path = scratch_path(spark, "scoring")
        J.fit_scoring(rows.filter(early), "o_orderkey", _TARGETS, path, members=6, priors=priors, numeric=["x"])
        out = J.publish_slate(rows.filter(~early).drop(*_TARGETS), "o_orderkey", path, _TARGETS, past.filter("n >= 5").select("o_custkey"), "o_custkey", "d", dt.date(1999, 6, 1),
                              scratch_path(spark, "published_slate"), dt.date(1999, 6, 1), priors=priors, dampen={"recent_minutes": "x_recent", "long_minutes": "x_long"})
        return round_doubles(out.select("o_orderkey", "o_custkey", "d", *[f"{t}_{m}" for t in _TARGETS for m in _P7_MEASURES], "run_date"), bits=12)


_register_publish_slate()


# P9 browse: round, search, pick column groups, sort, page ---------------------------------------------
@register("browse_page", """
WITH t AS (
  SELECT o.o_orderkey, round_even(o.o_totalprice / 7 + 0.001, 1) AS price_per_week,
         round_even(c.c_acctbal / 7 + 0.001, 1) AS acctbal_per_week, c.c_mktsegment, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey, price_per_week, acctbal_per_week FROM t
WHERE contains(lower(c_mktsegment), 'building') OR contains(lower(o_orderpriority), 'building')
ORDER BY price_per_week DESC, o_orderkey LIMIT 20 OFFSET 20
""")
def browse_page(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    t = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", (F.col("o_totalprice") / 7 + 0.001).alias("price_per_week"),
        (F.col("c_acctbal") / 7 + 0.001).alias("acctbal_per_week"), "c_mktsegment", "o_orderpriority")
    groups = {"ids": [r"key$"], "money": [r"_per_week$"], "labels": [r"segment$", r"priority$"]}
    return J.browse(t, [F.col("price_per_week").desc()], "o_orderkey", "Building", groups, ["ids", "money"], 2, 20)


# P4 again through the skew-safe path (range segments instead of one task per entity / date);
# it must produce exactly the same features, so it shares the oracle.
def player_feature_frame_skew_safe(spark, sf, partitions=None):
    e = ev(spark, sf).withColumn("season", F.year("ts"))
    return J.feature_build(e, "user_id", EV_ORDER, "d", ["value"], season="season",
                           context="event_type", context_values=("click", "view"), span=21, roll=5,
                           slope_min_rows=21, hot_metric="value",
                           interaction_pairs=[("value_ewm_mean", "value_exp_mean")],
                           skew_safe=True, partitions=partitions, rank_bits=20)


def _register_skew_safe():
    from tempolith.plans.catalog import ORACLE

    @register("player_features_skew_safe", ORACLE["player_features"])
    def player_features_skew_safe(spark, sf):
        df = player_feature_frame_skew_safe(spark, sf).select(*P4_COLS)
        df = round_doubles(df, skip=("value_ewm_mean_x_value_exp_mean",))
        return df.withColumn("value_ewm_mean_x_value_exp_mean", snap("value_ewm_mean_x_value_exp_mean", 12))


_register_skew_safe()


# P4 in long layout: metrics unpivoted once, every step on segments of (entity, metric, order); all columns ----------------
_LONG_PARTS = f"""
b AS (SELECT event_id, user_id, ts, ts::date AS d, 'value' AS metric, value AS x FROM events
      UNION ALL SELECT event_id, user_id, ts, ts::date AS d, 'k' AS metric, CAST(props->>'k' AS DOUBLE) AS x FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, metric ORDER BY ts, event_id) AS rn FROM b),
p AS (SELECT a.event_id, a.metric, q.x, CASE WHEN q.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2) ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - q.rn) END AS wt
      FROM r a JOIN r q ON a.user_id = q.user_id AND a.metric = q.metric AND q.rn < a.rn),
m AS (SELECT event_id, metric, sum(wt * x) AS mu, sum(wt * wt) AS w2 FROM p GROUP BY ALL),
v AS (SELECT p.event_id, p.metric, sum(p.wt * (p.x - m.mu) ^ 2) AS cov FROM p JOIN m USING (event_id, metric) GROUP BY ALL),
f AS (SELECT r.*, m.mu, CASE WHEN 1 - m.w2 > 1e-9 THEN sqrt(v.cov / (1 - m.w2)) END AS sd, lag(x, 1) OVER w AS lag1, lag(x, 2) OVER w AS lag2,
             avg(x) OVER wx AS em, stddev_samp(x) OVER wx AS es, max(x) OVER wx AS emax, min(x) OVER wx AS emin,
             lag(x, 5) OVER w AS x0, lag(x, 4) OVER w AS x1, lag(x, 3) OVER w AS x2, lag(x, 2) OVER w AS x3, lag(x, 1) OVER w AS x4
      FROM r LEFT JOIN m USING (event_id, metric) LEFT JOIN v USING (event_id, metric)
      WINDOW w AS (PARTITION BY r.user_id, r.metric ORDER BY r.ts, r.event_id),
             wx AS (PARTITION BY r.user_id, r.metric ORDER BY r.ts, r.event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, CASE WHEN x0 IS NOT NULL THEN (x0 + x1 + x2 + x3 + x4) / 5.0 END AS rm, coalesce(CASE WHEN lag1 > mu THEN 1 ELSE 0 END, 0) AS above,
             regr_slope(lag1, rn) OVER wr AS s, count(lag1) OVER wr AS ns, max(lag1) OVER wr AS hi, min(lag1) OVER wr AS lo, first_value(lag1 IGNORE NULLS) OVER wr AS y0
      FROM f WINDOW wr AS (PARTITION BY user_id, metric ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
i AS (SELECT *, sum(above) OVER (PARTITION BY user_id, metric ORDER BY ts, event_id) AS surges FROM g)"""
_LONG_COLS = """SNAP(lag1) AS x_lag1, SNAP(lag2) AS x_lag2, SNAP(em) AS x_exp_mean, SNAP(es) AS x_exp_std, SNAP(emax) AS x_exp_max, SNAP(emin) AS x_exp_min, SNAP(rm) AS x_roll_mean,
       SNAP(CASE WHEN x0 IS NOT NULL THEN sqrt(((x0-rm)^2 + (x1-rm)^2 + (x2-rm)^2 + (x3-rm)^2 + (x4-rm)^2) / 4.0) END) AS x_roll_std,
       SNAP(CASE WHEN x0 IS NOT NULL THEN (abs(x0-rm) + abs(x1-rm) + abs(x2-rm) + abs(x3-rm) + abs(x4-rm)) / 5.0 END) AS x_roll_mad,
       SNAP(CASE WHEN x0 IS NOT NULL THEN (-2*x0 - x1 + x3 + 2*x4) / 10.0 END) AS x_roll_trend,
       SNAP(CASE WHEN x0 IS NOT NULL THEN greatest(x0, x1, x2, x3, x4) END) AS x_roll_max, SNAP(CASE WHEN x0 IS NOT NULL THEN least(x0, x1, x2, x3, x4) END) AS x_roll_min,
       SNAP(mu) AS x_ewm_mean, SNAP(sd) AS x_ewm_std, SNAP(abs(lag1 - mu)) AS x_ewm_dev, SNAP(lag1 - em) AS x_delta"""
_LONG_NAMES = ["x_lag1", "x_lag2", "x_exp_mean", "x_exp_std", "x_exp_max", "x_exp_min", "x_roll_mean", "x_roll_std", "x_roll_mad", "x_roll_trend", "x_roll_max", "x_roll_min",
               "x_ewm_mean", "x_ewm_std", "x_ewm_dev", "x_delta"]
_LONG_RANKS = {"em": "exp_mean", "rm": "roll_mean", "mu": "ewm_mean", "sl": "slope"}


def _two_metrics(spark, sf):
    return ev(spark, sf).join(table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("double").alias("k")), "event_id")


@register("features_long", f"""
WITH {_LONG_PARTS},
gs AS (SELECT event_id, metric, d, SNAP(em) AS em, SNAP(rm) AS rm, SNAP(mu) AS mu, SNAP({_SLOPE}) AS sl FROM i),
{", ".join(f"""
k_{c} AS (SELECT a.event_id, a.metric, (count(*) FILTER (WHERE q.{c} < a.{c}) + (count(*) FILTER (WHERE q.{c} = a.{c}) + 1) / 2.0) / count(q.{c}) AS pr
         FROM gs a JOIN gs q ON a.d = q.d AND a.metric = q.metric WHERE a.{c} IS NOT NULL GROUP BY ALL)""" for c in _LONG_RANKS)}
SELECT i.event_id, i.metric, {_LONG_COLS}, above AS x_ewm_above, CAST(surges AS BIGINT) AS x_ewm_surges, SNAP({_SLOPE}) AS x_slope,
       {", ".join(f"SNAP(k_{c}.pr) AS x_{name}_prank" for c, name in _LONG_RANKS.items())}
FROM i {" ".join(f"LEFT JOIN k_{c} USING (event_id, metric)" for c in _LONG_RANKS)}
""")
def features_long(spark, sf):
    long = J.feature_build(_two_metrics(spark, sf), "user_id", EV_ORDER, "d", ["value", "k"], layout="long", rank_bits=20)
    return round_doubles(long.select("event_id", "metric", *_LONG_NAMES, "x_ewm_above", "x_ewm_surges", "x_slope", *[f"x_{name}_prank" for name in _LONG_RANKS.values()]))


# P4 with saved state: a run on the first half, one more week, then all with a late, a corrected and a removed row -----------
@register("features_from_state", f"""
WITH {_LONG_PARTS}
SELECT event_id, metric, {_LONG_COLS}, above AS x_ewm_above, CAST(surges AS BIGINT) AS x_ewm_surges FROM i
""")
def features_from_state(spark, sf):
    from tempolith.plans.feature_state import FeatureStore
    e = cut_lineage(_two_metrics(spark, sf))
    store = FeatureStore(spark, scratch_path(spark, "feature_state"), "user_id", EV_ORDER, ["value", "k"], buckets=16)
    day = lambda k: F.col("ts") < F.lit(dt.datetime(2024, 1, k)).cast("timestamp_ntz")
    third = F.col("user_id") % 50
    wrong = (e.filter(~((third == 3) & (F.col("event_id") % 2 == 0)))                                    # rows that come late
             .withColumn("value", F.when(third == 4, F.col("value") + 1).otherwise(F.col("value"))))          # values corrected since
    twice = wrong.unionByName(wrong.filter((third == 5) & (F.col("event_id") % 3 == 0)).withColumn("event_id", -F.col("event_id")))      # rows that go again
    store.update(twice.filter(day(12)))
    store.update(twice.filter(day(19)))
    store.update(e)
    return round_doubles(store.features().select("event_id", "metric", *_LONG_NAMES, "x_ewm_above", "x_ewm_surges"))


# P4 with the opponent block on the orders frame: entity customer, opponent = priority,
# team = market segment, metric = order price ------------------------------------------------
@register("features_opponent", f"""
WITH o AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, c.c_mktsegment, o.o_orderdate::date AS d,
         year(o.o_orderdate) AS season, o.o_totalprice AS x,
         row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) AS rn
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
pe AS (
  SELECT a.o_orderkey,
         sum(CASE WHEN q.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
                  ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - q.rn) END * q.x) AS mu
  FROM o a JOIN o q ON a.o_custkey = q.o_custkey AND q.rn < a.rn GROUP BY 1),
daily AS (SELECT o_orderpriority, season, d, coalesce(sum(x), 0) AS v FROM o GROUP BY ALL),
dr AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, season ORDER BY d) AS rn FROM daily),
de AS (
  SELECT a.o_orderpriority, a.season, a.d,
         sum(CASE WHEN q.rn = 1 THEN pow(1 - {ALPHA_SQL}, a.rn - 2)
                  ELSE {ALPHA_SQL} * pow(1 - {ALPHA_SQL}, a.rn - 1 - q.rn) END * q.v) AS al
  FROM dr a JOIN dr q ON a.o_orderpriority = q.o_orderpriority AND a.season = q.season AND q.rn < a.rn
  GROUP BY ALL),
j AS (
  SELECT o.o_orderkey, o.c_mktsegment, o.d, pe.mu, de.al
  FROM o LEFT JOIN pe USING (o_orderkey)
  LEFT JOIN de ON de.o_orderpriority = o.o_orderpriority AND de.season = o.season AND de.d = o.d)
SELECT o_orderkey, SNAP12(mu) AS x_ewm_mean, SNAP12(al) AS allowed_x_ewm,
       CASE WHEN mu = max(mu) OVER (PARTITION BY c_mktsegment, d) THEN 1 ELSE 0 END AS x_primary,
       SNAP12(mu * al / 1000000) AS x_ewm_x_allowed_musd
FROM j
""")
def features_opponent(spark, sf):
    o = orders_frame(spark, sf).withColumn("x", F.col("o_totalprice"))
    f = J.feature_build(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", ["x"], season="season",
                        opponent="o_orderpriority", opponent_stats=["x"], team="c_mktsegment", primary_metric="x")
    out = f.select("o_orderkey", "x_ewm_mean", "allowed_x_ewm", "x_primary",
                   (F.col("x_ewm_mean_x_allowed_x_ewm") / 1_000_000).alias("x_ewm_x_allowed_musd"))
    return out.withColumns({c: snap(c, 12) for c in ("x_ewm_mean", "allowed_x_ewm", "x_ewm_x_allowed_musd")})
