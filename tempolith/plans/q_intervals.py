"""Interval reconstruction queries.

CH: events as a change log - group user_id % 10, member user_id, hourly
clock, in = signup/purchase, out = error, starters = first 10 members seen
in other events.  IV: lineitem as intervals - event l_orderkey % 200, team
l_returnflag, interval l_orderkey, members = distinct l_suppkey % 12.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tempolith.functions import numeric as NU
from tempolith.functions import text as TX
from tempolith.operators import aggs as D
from tempolith.operators import intervals as IV
from tempolith.operators import joins as C
from tempolith.plans.bindings import round_doubles
from tempolith.plans.catalog import register
from tempolith.session import cut_lineage
from tempolith.sources.tables import table

CHANGE_TYPES = ("signup", "purchase", "error")
CH_SIZE = 10


def ch_events(spark, sf):
    e = table(spark, sf, "events")
    clk = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) * 24 + F.hour("ts")).cast("long")
    return e.select("event_id", "user_id", (F.col("user_id") % 10).alias("grp"), "event_type", "value",
                    clk.alias("clk"))


def ch_parts(spark, sf):
    e = ch_events(spark, sf)
    changes = (e.filter(F.col("event_type").isin(*CHANGE_TYPES))
               .select("grp", "user_id", "clk", F.col("event_type").isin("signup", "purchase").alias("is_in")))
    starters = IV.first_members(e, "grp", "user_id", "event_id", n=CH_SIZE,
                                exclude=F.col("event_type").isin(*CHANGE_TYPES)).select("grp", "user_id")
    spans = e.groupBy("grp").agg((F.min("clk") - 1).alias("start"), F.max("clk").alias("end"))
    return e, changes, starters, spans


_CH_SQL = f"""
e AS (SELECT event_id, user_id, user_id % 10 AS grp, event_type, value,
             CAST(date_diff('day', DATE '2024-01-01', ts::date) * 24 + hour(ts) AS BIGINT) AS clk FROM events),
sp AS (SELECT grp, min(clk) - 1 AS st, max(clk) AS en FROM e GROUP BY grp),
ch AS (SELECT grp, user_id, clk, event_type IN ('signup', 'purchase') AS is_in FROM e
       WHERE event_type IN ('signup', 'purchase', 'error')),
starters AS (
  SELECT grp, user_id FROM (
    SELECT grp, user_id, min(event_id) AS f FROM e WHERE event_type NOT IN ('signup', 'purchase', 'error') GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY grp ORDER BY f, user_id) <= {CH_SIZE}),
bd AS (SELECT DISTINCT grp, b FROM (SELECT grp, clk AS b FROM ch UNION ALL SELECT grp, st FROM sp
                                    UNION ALL SELECT grp, en FROM sp)),
iv AS (SELECT grp, b AS start_, lead(b) OVER (PARTITION BY grp ORDER BY b) AS end_,
              row_number() OVER (PARTITION BY grp ORDER BY b) AS k FROM bd),
allc AS (SELECT grp, user_id, clk, CASE WHEN is_in THEN 2 ELSE 1 END AS prio, is_in FROM ch
         UNION ALL SELECT s.grp, s.user_id, sp.st, 0, true FROM starters s JOIN sp USING (grp)),
mem AS (SELECT DISTINCT grp, user_id FROM allc),
state AS (
  SELECT iv.grp, iv.k, iv.start_, iv.end_, m.user_id,
         (SELECT arg_max(c.is_in, c.clk * 10 + c.prio) FROM allc c
          WHERE c.grp = iv.grp AND c.user_id = m.user_id AND c.clk <= iv.start_) AS on_
  FROM iv JOIN mem m USING (grp) WHERE iv.end_ IS NOT NULL),
lineups AS (
  SELECT grp, k, start_, end_, string_agg(CAST(user_id AS VARCHAR), '-' ORDER BY user_id) AS lineup,
         count(*) AS n_active
  FROM state WHERE on_ GROUP BY ALL HAVING count(*) = {CH_SIZE})"""


# W23 first members ------------------------------------------------------------------
@register("first_members", """
SELECT event_type, user_id, CAST(slot AS INTEGER) AS slot FROM (
  SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY min(event_id), user_id) AS slot
  FROM events GROUP BY event_type, user_id)
WHERE slot <= 5
""")
def first_members(spark, sf):
    e = table(spark, sf, "events")
    return IV.first_members(e, "event_type", "user_id", "event_id", n=5).select("event_type", "user_id", "slot")


# W24 active sets ----------------------------------------------------------------------
@register("active_intervals", f"""
WITH {_CH_SQL}
SELECT grp, CAST(k AS INTEGER) AS k, start_ AS "start", end_ AS "end", end_ - start_ AS duration, lineup,
       CAST(n_active AS INTEGER) AS n_active, round((end_ - start_) * 3600 / 60.0, 1) AS duration_minutes
FROM lineups
""")
def active_intervals(spark, sf):
    e, changes, starters, spans = ch_parts(spark, sf)
    iv = IV.active_intervals(changes, starters, spans, "grp", "user_id", "clk", "is_in", size=CH_SIZE)
    minutes = NU.seconds_to_minutes(F.col("duration") * 3600).alias("duration_minutes")
    return iv.select("grp", "k", "start", "end", "duration", "lineup", "n_active", minutes)


# C11 + D8 events into intervals, conditional counters ------------------------------------
@register("interval_counters", f"""
WITH {_CH_SQL},
hit AS (  -- range join: event hour in (start, end]
  SELECT l.grp, l.k, e.event_type, e.value
  FROM lineups l JOIN e ON e.grp = l.grp AND e.clk > l.start_ AND e.clk <= l.end_)
SELECT l.grp, CAST(l.k AS INTEGER) AS k, l.lineup,
       count(h.k) AS n_events,
       SNAP(coalesce(sum(h.value), 0)) AS value_sum,
       count(*) FILTER (WHERE h.event_type = 'click') AS n_click,
       count(*) FILTER (WHERE h.value > 100) AS n_big
FROM lineups l LEFT JOIN hit h ON h.grp = l.grp AND h.k = l.k
GROUP BY l.grp, l.k, l.lineup
""")
def interval_counters(spark, sf):
    e, changes, starters, spans = ch_parts(spark, sf)
    # both are read by several branches: written once
    bnd = cut_lineage(IV.boundaries(changes, spans, "grp", "clk"))
    iv = cut_lineage(IV.active_intervals(changes, starters, spans, "grp", "user_id", "clk", "is_in", size=CH_SIZE, bnd=bnd))
    placed = IV.assign_intervals(e, bnd, "grp", "clk", bucket_width=24.0, closed="right")
    cnt = D.count_where(placed.filter(F.col("k").isNotNull()), ["grp", "k"],
                        {"n_click": F.col("event_type") == "click", "n_big": F.col("value") > 100},
                        {"value_sum": F.col("value"), "n_events": F.lit(1)})
    out = iv.select("grp", "k", "lineup").join(cnt, ["grp", "k"], "left")
    out = out.select("grp", "k", "lineup",
                     F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events"),
                     F.coalesce("value_sum", F.lit(0.0)).alias("value_sum"),
                     F.coalesce("n_click", F.lit(0)).alias("n_click"),
                     F.coalesce("n_big", F.lit(0)).alias("n_big"))
    return round_doubles(out)


# D5-D7 on/off over CH intervals -------------------------------------------------------------
@register("on_off_split", f"""
WITH {_CH_SQL},
hit AS (SELECT l.grp, l.k, count(*) AS n_ev, sum(e.value) AS v
        FROM lineups l JOIN e ON e.grp = l.grp AND e.clk > l.start_ AND e.clk <= l.end_ GROUP BY ALL),
ivc AS (SELECT l.grp, l.k, l.lineup, coalesce(h.n_ev, 0) AS n_ev, coalesce(h.v, 0) AS v
        FROM lineups l LEFT JOIN hit h USING (grp, k)),
lm AS (SELECT DISTINCT grp, CAST(unnest(string_split(lineup, '-')) AS BIGINT) AS member FROM ivc),
onx AS (SELECT m.grp, m.member, count(*) AS n_on, sum(i.n_ev) AS on_n_ev, sum(i.v) AS on_v
        FROM lm m JOIN ivc i ON i.grp = m.grp AND list_contains(string_split(i.lineup, '-'), CAST(m.member AS VARCHAR))
        GROUP BY ALL),
offx AS (SELECT m.grp, m.member, sum(i.n_ev) AS off_n_ev, sum(i.v) AS off_v
         FROM lm m JOIN ivc i ON i.grp = m.grp AND NOT list_contains(string_split(i.lineup, '-'), CAST(m.member AS VARCHAR))
         GROUP BY ALL)
SELECT o.grp, o.member, o.n_on, CAST(o.on_n_ev AS BIGINT) AS on_n_ev, SNAP(o.on_v) AS on_v,
       CAST(f.off_n_ev AS BIGINT) AS off_n_ev, SNAP(f.off_v) AS off_v
FROM onx o LEFT JOIN offx f USING (grp, member)
""")
def on_off_split(spark, sf):
    out = IV.on_off(counted_intervals(*ch_parts(spark, sf)), "grp", ["n_ev", "v"])
    return round_doubles(out.select("grp", "member", "n_on", "on_n_ev", "on_v", "off_n_ev", "off_v"))


def counted_intervals(e, changes, starters, spans):
    """Intervals of the change log with the number and sum of their events.

    Boundaries and intervals are read by several branches: written once."""
    bnd = cut_lineage(IV.boundaries(changes, spans, "grp", "clk"))
    iv = cut_lineage(IV.active_intervals(changes, starters, spans, "grp", "user_id", "clk", "is_in", size=CH_SIZE, bnd=bnd))
    placed = IV.assign_intervals(e, bnd, "grp", "clk", bucket_width=24.0, closed="right")
    cnt = placed.filter(F.col("k").isNotNull()).groupBy("grp", "k").agg(
        F.count(F.lit(1)).alias("n_ev"), F.sum("value").alias("v"))
    return cut_lineage(iv.join(cnt, ["grp", "k"], "left").withColumns(
        {"n_ev": F.coalesce("n_ev", F.lit(0)), "v": F.coalesce("v", F.lit(0.0))}))


# W24 two teams in a group: a change of either ends both teams' intervals; short ones and a known-bad group stay out -----------
@register("team_intervals", f"""
WITH e AS (SELECT user_id, user_id % 10 AS grp, user_id % 2 AS team, event_type,
                  CAST(date_diff('day', DATE '2024-01-01', ts::date) * 24 + hour(ts) AS BIGINT) AS clk, event_id FROM events WHERE user_id % 10 < 4 OR user_id % 10 = 9),
g AS (SELECT user_id, grp % 2 AS ev, user_id // 10 % 2 AS side, event_type, clk, event_id FROM e),
sp AS (SELECT ev, side, min(clk) OVER (PARTITION BY ev) - 1 AS st, max(clk) OVER (PARTITION BY ev) AS en FROM g QUALIFY row_number() OVER (PARTITION BY ev, side) = 1),
ch AS (SELECT ev, side, user_id, clk, event_type IN ('signup', 'purchase') AS is_in FROM g WHERE event_type IN ('signup', 'purchase', 'error')),
starters AS (SELECT ev, side, user_id FROM (SELECT ev, side, user_id, min(event_id) AS f FROM g WHERE event_type NOT IN ('signup', 'purchase', 'error') GROUP BY ALL)
             QUALIFY row_number() OVER (PARTITION BY ev, side ORDER BY f, user_id) <= {CH_SIZE}),
bd AS (SELECT DISTINCT ev, b FROM (SELECT ev, clk AS b FROM ch UNION ALL SELECT ev, st FROM sp UNION ALL SELECT ev, en FROM sp)),
iv AS (SELECT ev, b AS start_, lead(b) OVER (PARTITION BY ev ORDER BY b) AS end_, row_number() OVER (PARTITION BY ev ORDER BY b) AS k FROM bd),
allc AS (SELECT ev, side, user_id, clk, CASE WHEN is_in THEN 2 ELSE 1 END AS prio, is_in FROM ch
         UNION ALL SELECT s.ev, s.side, s.user_id, sp.st, 0, true FROM starters s JOIN sp USING (ev, side)),
mem AS (SELECT DISTINCT ev, side, user_id FROM allc),
state AS (SELECT iv.ev, m.side, iv.k, iv.start_, iv.end_, m.user_id,
                 (SELECT arg_max(c.is_in, c.clk * 10 + c.prio) FROM allc c WHERE c.ev = iv.ev AND c.side = m.side AND c.user_id = m.user_id AND c.clk <= iv.start_) AS on_
          FROM iv JOIN mem m USING (ev) WHERE iv.end_ IS NOT NULL)
SELECT ev, side, CAST(k AS INTEGER) AS k, start_ AS "start", end_ AS "end", string_agg(CAST(user_id AS VARCHAR), '-' ORDER BY user_id) AS lineup, CAST(count(*) AS INTEGER) AS n_active
FROM state WHERE on_ AND end_ - start_ >= 2 AND NOT (ev = 1 AND side = 1) GROUP BY ALL
""")
def team_intervals(spark, sf):
    e = ch_events(spark, sf).filter((F.col("grp") < 4) | (F.col("grp") == 9))
    g = e.select("user_id", (F.col("grp") % 2).alias("ev"), (F.floor(F.col("user_id") / 10) % 2).alias("side"), "event_type", "clk", "event_id")
    changes = g.filter(F.col("event_type").isin(*CHANGE_TYPES)).select("ev", "side", "user_id", "clk", F.col("event_type").isin("signup", "purchase").alias("is_in"))
    starters = IV.first_members(g, ["ev", "side"], "user_id", "event_id", n=CH_SIZE, exclude=F.col("event_type").isin(*CHANGE_TYPES)).select("ev", "side", "user_id")
    whole = g.groupBy("ev").agg((F.min("clk") - 1).alias("start"), F.max("clk").alias("end"))
    spans = g.select("ev", "side").distinct().join(whole, "ev")
    bnd = cut_lineage(IV.boundaries(changes, spans, ["ev", "side"], "clk", event="ev"))
    iv = IV.active_intervals(changes, starters, spans, ["ev", "side"], "user_id", "clk", "is_in", size=None, min_duration=2, bnd=bnd)
    iv = iv.filter((F.col("n_active") > 0) & ~((F.col("ev") == 1) & (F.col("side") == 1)))
    return iv.select("ev", "side", "k", "start", "end", "lineup", "n_active")


# IV frame: C12 roster, D9 members, U4 array sets, F12 id lists -------------------------------
def iv_intervals(spark, sf):
    li = table(spark, sf, "lineitem")
    li = li.select((F.col("l_orderkey") % 200).alias("event"), F.col("l_returnflag").alias("team"),
                   F.col("l_orderkey").alias("interval"), (F.col("l_suppkey") % 12).alias("member"),
                   "l_quantity", "l_extendedprice", "l_discount")
    return li


@register("members_roster", """
WITH li AS (SELECT l_orderkey % 200 AS event, l_returnflag AS team, l_orderkey AS interval, l_suppkey % 12 AS member
            FROM lineitem),
ivm AS (SELECT event, team, interval, list_sort(list(DISTINCT member)) AS m FROM li GROUP BY ALL),
ros AS (SELECT event, team, list_sort(list(DISTINCT member)) AS r FROM li GROUP BY ALL)
SELECT i.event, i.team, i.interval,
       array_to_string(i.m, '-') AS lineup,
       array_to_string(r.r, '-') AS roster,
       array_to_string(list_sort(list_filter(r.r, lambda x: NOT list_contains(i.m, x))), '-') AS bench,
       len(i.m) AS n_members
FROM ivm i JOIN ros r USING (event, team)
""")
def members_roster(spark, sf):
    li = iv_intervals(spark, sf)
    per_iv = D.members(li, ["event", "team", "interval"], "member", out="m")
    j = per_iv.join(D.members(li, ["event", "team"], "member", out="r"), ["event", "team"])
    sets = C.array_sets("r", "m")
    return j.select("event", "team", "interval",
                    TX.join_ids("m").alias("lineup"), TX.join_ids("r").alias("roster"),
                    TX.join_ids(sets["only_left"]).alias("bench"),
                    F.size("m").cast("long").alias("n_members"))


@register("member_totals", """
WITH li AS (SELECT l_orderkey % 200 AS event, l_returnflag AS team, l_orderkey AS interval, l_suppkey % 12 AS member,
                   l_quantity, l_extendedprice, l_discount FROM lineitem),
ivs AS (SELECT event, team, interval, array_to_string(list_sort(list(DISTINCT member)), '-') AS lineup,
               sum(l_quantity) AS qty, sum(l_extendedprice) AS price, avg(l_discount) AS disc
        FROM li GROUP BY ALL),
ex AS (SELECT event, team, interval, CAST(unnest(string_split(lineup, '-')) AS BIGINT) AS member, qty, price, disc FROM ivs)
SELECT member, team, SNAP(sum(qty)) AS qty_total, count(DISTINCT interval) AS n_interval,
       SNAP(sum(disc * price) / nullif(sum(price), 0)) AS disc_wmean
FROM ex GROUP BY member, team
""")
def member_totals(spark, sf):
    li = iv_intervals(spark, sf)
    ivs = li.groupBy("event", "team", "interval").agg(
        TX.join_ids(F.collect_set("member")).alias("lineup"), F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("price"), F.avg("l_discount").alias("disc"))
    tot = D.member_totals(ivs, "lineup", ["team"], ["qty"], "interval")
    ex = ivs.withColumn("member", F.explode(TX.id_list("lineup")))
    wm = D.weighted_mean(ex, ["member", "team"], "disc", "price", out="disc_wmean")
    out = tot.join(wm, ["member", "team"])
    return round_doubles(out.select("member", "team", "qty_total", "n_interval", "disc_wmean"))


@register("iv_on_off", """
WITH li AS (SELECT l_orderkey % 200 AS event, l_returnflag AS team, l_orderkey AS interval, l_suppkey % 12 AS member,
                   l_quantity, l_extendedprice FROM lineitem),
ivs AS (SELECT event, team, interval, list(DISTINCT member) AS m, sum(l_quantity) AS qty, sum(l_extendedprice) AS price
        FROM li GROUP BY ALL),
ros AS (SELECT DISTINCT event, team, member FROM li),
onx AS (SELECT r.event, r.team, r.member, count(*) AS n_on, sum(i.qty) AS on_qty, sum(i.price) AS on_price
        FROM ros r JOIN ivs i ON i.event = r.event AND i.team = r.team AND list_contains(i.m, r.member) GROUP BY ALL),
offx AS (SELECT r.event, r.team, r.member, sum(i.qty) AS off_qty, sum(i.price) AS off_price
         FROM ros r JOIN ivs i ON i.event = r.event AND i.team = r.team AND NOT list_contains(i.m, r.member) GROUP BY ALL)
SELECT o.event, o.team, o.member, o.n_on, SNAP(o.on_qty) AS on_qty, SNAP12(o.on_price) AS on_price,
       SNAP(f.off_qty) AS off_qty, SNAP12(f.off_price) AS off_price
FROM onx o LEFT JOIN offx f USING (event, team, member)
""")
def iv_on_off(spark, sf):
    li = iv_intervals(spark, sf)
    ivs = li.groupBy("event", "team", "interval").agg(
        F.array_sort(F.collect_set("member")).alias("members"),
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("price"))
    out = IV.on_off(ivs, ["event", "team"], ["qty", "price"]).withColumnRenamed("member", "member")
    out = round_doubles(out, skip=("on_price", "off_price"))
    from tempolith.plans.bindings import snap
    out = out.withColumns({"on_price": snap("on_price", 12), "off_price": snap("off_price", 12)})
    return out.select("event", "team", "member", "n_on", "on_qty", "on_price", "off_qty", "off_price")
