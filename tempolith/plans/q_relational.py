"""Filter, join, aggregate, sort and set-operation queries (B, C, D, S, U)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tempolith.functions import text as TX
from tempolith.operators import aggs as D
from tempolith.operators import filters as B
from tempolith.operators import joins as C
from tempolith.operators import sorting as S
from tempolith.plans.bindings import ntz, ev, ev_gaps, orders_frame, round_doubles
from tempolith.plans.catalog import register
from tempolith.session import scratch_path
from tempolith.sources.tables import table


# B1, B2, B12 ---------------------------------------------------------------------------
@register("align_columns", """
SELECT o_orderkey AS order_id, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       CAST(NULL AS VARCHAR) AS o_clerk,
       coalesce(o_totalprice, 0.0) AS o_totalprice,
       CAST(0 AS INTEGER) AS is_flagged
FROM orders
""")
def align_columns(spark, sf):
    o = table(spark, sf, "orders")
    o = B.drop(o, "o_comment", "o_orderpriority")      # o_comment is absent: ignored
    o = B.ensure_columns(o, {"o_totalprice": ("double", 0.0), "is_flagged": ("int", 0)})
    return B.align_to(o, ["order_id", "o_custkey", "o_orderdate", "o_clerk", "o_totalprice", "is_flagged"],
                      rename={"o_orderkey": "order_id"}, types={"o_orderdate": "date"})


# B3 exclude a code list, B4 year filter, B13 code-set flag ----------------------------------
@register("exclude_since_flag", """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_priority
FROM orders
WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') AND o_orderdate >= DATE '1999-01-01'
""")
def exclude_since_flag(spark, sf):
    o = table(spark, sf, "orders")
    o = B.exclude(o, "o_orderpriority", ["5-LOW", "4-NOT SPECIFIED"])
    o = B.since_year(o, "o_orderdate", 1999)
    o = B.flag_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"], "is_priority")
    return o.select("o_orderkey", "o_orderpriority", "is_priority")


# B5 complete rows, B7 participation -------------------------------------------------------
@register("complete_participating", """
SELECT event_id, user_id, value
FROM (SELECT event_id, user_id, event_type,
             CASE WHEN event_id % 7 <> 0 THEN value END AS value,
             CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type = 'error' END AS is_error
      FROM events)
WHERE value IS NOT NULL AND is_error = false AND value > 0
""")
def complete_participating(spark, sf):
    e = ev_gaps(spark, sf).withColumn(
        "is_error", F.when(F.col("event_id") % 11 != 0, F.col("event_type") == "error"))
    e = B.complete_rows(e, ["value"])
    e = B.participated(e, "is_error", "value")
    return e.select("event_id", "user_id", "value")


# B6 case-insensitive prefix ----------------------------------------------------------------
@register("prefix_filter", """
SELECT c_custkey, c_name FROM customer WHERE lower(c_name) LIKE 'customer#0000001%'
""")
def prefix_filter(spark, sf):
    return B.starts_with(table(spark, sf, "customer"), "c_name", "CUSTOMER#0000001").select("c_custkey", "c_name")


# B8 entities with >= 10 rows ---------------------------------------------------------------
@register("min_rows", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 10)
""")
def min_rows(spark, sf):
    return B.min_rows(table(spark, sf, "orders"), "o_custkey", 10).select("o_orderkey", "o_custkey")


# B9, C5 qualify (entity, season) by mean ------------------------------------------------------
@register("qualify_mean", """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, o_totalprice FROM orders)
SELECT o.o_orderkey, o.o_custkey, o.season FROM o
JOIN (SELECT o_custkey, season FROM o GROUP BY ALL HAVING avg(o_totalprice) >= 200000) q
  ON o.o_custkey = q.o_custkey AND o.season = q.season
""")
def qualify_mean(spark, sf):
    o = orders_frame(spark, sf, customer=False)
    return B.qualify(o, ["o_custkey", "season"], "o_totalprice", 200000).select("o_orderkey", "o_custkey", "season")


# B10, C4 active in a season -----------------------------------------------------------------
@register("active_in_season", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND year(p.o_orderdate) = 2001)
""")
def active_in_season(spark, sf):
    o = orders_frame(spark, sf, customer=False)
    return B.active_in(o, "o_custkey", "season", 2001).select("o_orderkey", "o_custkey")


# B11 placeholder rows dropped ---------------------------------------------------------------
@register("drop_placeholder", """
SELECT c_custkey, c_mktsegment FROM customer WHERE coalesce(c_mktsegment, '') <> 'AUTOMOBILE'
""")
def drop_placeholder(spark, sf):
    c = table(spark, sf, "customer")
    return B.drop_placeholder(c, ["c_mktsegment"], "AUTOMOBILE").select("c_custkey", "c_mktsegment")


# B14 next slate --------------------------------------------------------------------------
@register("next_slate", """
SELECT event_id, ts::date AS d FROM events
WHERE ts::date = coalesce((SELECT min(ts::date) FROM events WHERE ts::date >= DATE '2024-01-20'),
                          (SELECT max(ts::date) FROM events))
""")
def next_slate(spark, sf):
    e = ev(spark, sf)
    return B.next_slate(e, "d", dt.date(2024, 1, 20)).select("event_id", "d")


@register("next_slate_fallback", """
SELECT event_id, ts::date AS d FROM events
WHERE ts::date = coalesce((SELECT min(ts::date) FROM events WHERE ts::date >= DATE '2030-01-01'),
                          (SELECT max(ts::date) FROM events))
""")
def next_slate_fallback(spark, sf):
    e = ev(spark, sf)
    return B.next_slate(e, "d", dt.date(2030, 1, 1)).select("event_id", "d")


# B15 first active week -------------------------------------------------------------------
@register("week_window", """
WITH o AS (SELECT o_orderdate::date AS d, o_orderpriority FROM orders
           WHERE o_orderdate::date BETWEEN DATE '1999-06-01' AND DATE '1999-06-01' + INTERVAL 365 DAY),
f AS (SELECT min(d) AS first_day FROM o)
SELECT DISTINCT d, o_orderpriority FROM o, f WHERE d <= f.first_day + INTERVAL 6 DAY
""")
def week_window(spark, sf):
    o = table(spark, sf, "orders")
    out = B.week_window(o, "o_orderdate", dt.date(1999, 6, 1), days=7, horizon=365)
    return out.select(F.to_date("o_orderdate").alias("d"), "o_orderpriority").distinct()


# B16 search every column --------------------------------------------------------------------
@register("search_all", """
SELECT * FROM supplier
WHERE contains(lower(CAST(s_suppkey AS VARCHAR)), '#00000001')
   OR contains(lower(s_name), '#00000001')
   OR contains(lower(CAST(s_nationkey AS VARCHAR)), '#00000001')
   OR contains(lower(CAST(s_acctbal AS VARCHAR)), '#00000001')
""")
def search_all(spark, sf):
    return B.search_all(table(spark, sf, "supplier"), "#00000001")


# B17 column groups picked from a table -------------------------------------------------------
LINEITEM_GROUPS = {"keys": [r"key$", r"linenumber$"], "money": [r"price$", r"discount$", r"tax$"],
                   "status": [r"flag$", r"status$"]}


@register("pick_column_group", """
SELECT l_extendedprice, l_discount, l_tax FROM lineitem
""")
def pick_column_group(spark, sf):
    li = table(spark, sf, "lineitem")
    groups = B.group_columns(li.columns, LINEITEM_GROUPS)
    return li.select(*groups["money"])


# B18 required columns / non-empty guard -------------------------------------------------------
@register("require_guard", """
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus
""")
def require_guard(spark, sf):
    o = B.require(table(spark, sf, "orders"), ["o_orderstatus", "o_orderkey"], non_empty=True)
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# C1, C2, C13 enrichment chain -----------------------------------------------------------------
@register("enrich_lineitem", """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate::date AS o_orderdate, c.c_mktsegment, n.n_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def enrich_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = C.enrich_on(li, o, [("l_orderkey", "o_orderkey")])
    j = C.enrich(j, c, "o_custkey")
    j = C.lookup(j, n, "c_nationkey")
    return j.select("l_orderkey", "l_linenumber", "o_orderdate", "c_mktsegment", "n_name")


# C3 presence flag ----------------------------------------------------------------------------
@register("flag_presence", """
WITH o AS (SELECT o.o_orderkey, c.c_mktsegment, o.o_orderdate::date AS d, o.o_orderpriority
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
u AS (SELECT DISTINCT c_mktsegment, d FROM o WHERE o_orderpriority = '1-URGENT')
SELECT o.o_orderkey, coalesce(u.d IS NOT NULL, false) AS urgent_day
FROM o LEFT JOIN u ON o.c_mktsegment = u.c_mktsegment AND o.d = u.d
""")
def flag_presence(spark, sf):
    o = orders_frame(spark, sf).withColumnRenamed("o_orderdate", "d")
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT")
    out = C.flag_if_present(o, urgent, ["c_mktsegment", "d"], "urgent_day")
    return out.select("o_orderkey", "urgent_day")


# C6 full outer join ---------------------------------------------------------------------------
@register("full_outer", """
SELECT coalesce(c.nk, s.nk) AS nationkey, c.n_customers, s.n_suppliers
FROM (SELECT c_nationkey AS nk, count(*) AS n_customers FROM customer GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS nk, count(*) AS n_suppliers FROM supplier GROUP BY 1) s
  ON c.nk = s.nk
""")
def full_outer(spark, sf):
    c = (table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nationkey"))
         .agg(F.count(F.lit(1)).alias("n_customers")))
    s = (table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey"))
         .agg(F.count(F.lit(1)).alias("n_suppliers")))
    return C.full(c, s, "nationkey")


# C7 join to first row per key -------------------------------------------------------------------
@register("enrich_first", """
SELECT o.o_orderkey, f.l_linenumber AS top_line, f.l_extendedprice AS top_price
FROM orders o LEFT JOIN (
  SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) = 1) f
ON o.o_orderkey = f.l_orderkey
""")
def enrich_first(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                              F.col("l_linenumber").alias("top_line"),
                                              F.col("l_extendedprice").alias("top_price"))
    return C.enrich_first(o, li, "o_orderkey", [F.col("top_price").desc(), F.col("top_line")])


# C8, C9 both sides + roster expansion ---------------------------------------------------------------
@register("both_sides_roster", """
WITH g AS (SELECT n_nationkey AS home, (n_nationkey + 1) % 25 AS away, n_regionkey AS week FROM nation),
s AS (SELECT week, home AS team, away AS opponent, 'home' AS side FROM g
      UNION ALL SELECT week, away, home, 'away' FROM g)
SELECT s.week, s.team, s.opponent, s.side, p.s_suppkey
FROM s LEFT JOIN supplier p ON p.s_nationkey = s.team
""")
def both_sides_roster(spark, sf):
    g = table(spark, sf, "nation").select(F.col("n_nationkey").alias("home"),
                                           ((F.col("n_nationkey") + 1) % 25).alias("away"),
                                           F.col("n_regionkey").alias("week"))
    sides = C.double_sides(g, "home", "away")
    roster = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("team"), "s_suppkey")
    return C.expand_roster(sides, roster, "team").select("week", "team", "opponent", "side", "s_suppkey")


# C10, W22 latest row attached through a normalised key ------------------------------------------------
@register("attach_latest", """
WITH l AS (SELECT o_custkey, o_orderkey, o_orderdate::date AS o_orderdate, o_totalprice FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c.c_custkey, c.c_name, l.o_orderkey AS last_order, l.o_orderdate AS last_date, l.o_totalprice AS last_price
FROM customer c LEFT JOIN l ON lower(c.c_name) = lower('customer#' || lpad(CAST(l.o_custkey AS VARCHAR), 9, '0'))
""")
def attach_latest(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("last_order"),
                                           F.to_date("o_orderdate").alias("last_date"),
                                           F.col("o_totalprice").alias("last_price"))
    hist_key = F.lower(F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
    j = C.attach_latest(c, o, F.lower("c_name"), hist_key, ["last_date", "last_order"])
    return j.select("c_custkey", "c_name", "last_order", "last_date", "last_price")


# D1 rate above threshold ------------------------------------------------------------------------
@register("rate_above", """
SELECT user_id, SNAP(avg(CAST(event_type = 'click' AS INTEGER))) AS click_rate
FROM events GROUP BY user_id HAVING avg(CAST(event_type = 'click' AS INTEGER)) > 0.2
""")
def rate_above(spark, sf):
    e = ev(spark, sf).withColumn("is_click", F.col("event_type") == "click")
    return round_doubles(D.rate_above(e, "user_id", "is_click", 0.2, out="click_rate"))


# D2 daily sums (NULL-only groups sum to 0) --------------------------------------------------------
@register("daily_sums", """
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderdate::date AS d,
       SNAP(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END), 0)) AS price
FROM orders GROUP BY ALL
""")
def daily_sums(spark, sf):
    o = orders_frame(spark, sf, customer=False).withColumn(
        "price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    out = D.daily_sum(o.withColumnRenamed("o_orderdate", "d"), ["o_orderpriority", "season", "d"], ["price"])
    return round_doubles(out)


# D10, D13 group total and argmax flag; D14 per-id summary; D15 distinct count ---------------------------
@register("group_total_max_flag", """
SELECT event_id, event_type, ts::date AS d,
       SNAP(sum(value) OVER (PARTITION BY event_type, ts::date)) AS value_group_total,
       CASE WHEN value = max(value) OVER (PARTITION BY event_type, ts::date) THEN 1 ELSE 0 END AS is_top
FROM events
""")
def group_total_max_flag(spark, sf):
    e = ev(spark, sf)
    e = D.group_total(e, ["event_type", "d"], "value")
    e = D.is_group_max(e, ["event_type", "d"], "value", "is_top")
    return round_doubles(e.select("event_id", "event_type", "d", "value_group_total", "is_top"))


@register("id_summary", """
SELECT user_id, min(ts) AS min_date, max(ts) AS max_date, count(*) AS n_rows FROM events GROUP BY user_id
""")
def id_summary(spark, sf):
    return D.id_summary(table(spark, sf, "events"), "user_id", "ts")


@register("n_distinct", """
SELECT count(DISTINCT l_suppkey) AS n_distinct_l_suppkey FROM lineitem
""")
def n_distinct(spark, sf):
    return D.n_distinct(table(spark, sf, "lineitem"), "l_suppkey")


# D8 conditional counters ----------------------------------------------------------------------------
@register("conditional_counts", """
SELECT l_orderkey % 200 AS event, l_returnflag AS team,
       count(*) FILTER (WHERE l_linestatus = 'F' AND contains(lower(l_shipmode_txt), 'air')) AS n_air_done,
       count(*) FILTER (WHERE l_discount > 0.05) AS n_big_discount,
       count(*) FILTER (WHERE l_tax = 0) AS n_untaxed,
       SNAP(sum(l_quantity)) AS qty
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 'AIR' WHEN l_linenumber % 3 = 1 THEN 'rail' END AS l_shipmode_txt
      FROM lineitem)
GROUP BY ALL
""")
def conditional_counts(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({
        "event": F.col("l_orderkey") % 200, "team": F.col("l_returnflag"),
        "mode": F.when(F.col("l_linenumber") % 3 == 0, "AIR").when(F.col("l_linenumber") % 3 == 1, "rail")})
    preds = {"n_air_done": (F.col("l_linestatus") == "F") & F.lower("mode").contains("air"),
             "n_big_discount": F.col("l_discount") > 0.05,
             "n_untaxed": F.col("l_tax") == 0}
    return round_doubles(D.count_where(li, ["event", "team"], preds, {"qty": F.col("l_quantity")}))


# D11 distinct, D12 first per key -----------------------------------------------------------------------
@register("distinct_texts", """
SELECT count(*) AS n_distinct_texts FROM (SELECT DISTINCT text FROM documents)
""")
def distinct_texts(spark, sf):
    d = D.distinct(table(spark, sf, "documents").select("text"))
    return d.agg(F.count(F.lit(1)).alias("n_distinct_texts"))


@register("first_per_source", """
SELECT source, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1
""")
def first_per_source(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return D.first_per(d, "source", [F.col("n_chars").desc(), F.col("doc_id")])


# S1, S3 page of a sorted result; S2 top-n per group -------------------------------------------------------
@register("order_page", """
SELECT o_orderkey, o_orderdate::date AS o_orderdate FROM orders
ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 50
""")
def order_page(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return S.page(o, ["o_orderdate", "o_orderkey"], page_no=3, size=25)


# S3 a deep page as a range read: the sorted result is written once, with positions ------------------------------------------
@register("deep_page", """
SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber) - 1 AS position FROM lineitem
ORDER BY position LIMIT 50 OFFSET (SELECT (count(*) // 50 - 40) * 50 FROM lineitem)
""")
def deep_page(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    pages = S.PagedTable.write(li, [F.col("l_extendedprice").desc_nulls_last(), F.col("l_orderkey")], "l_linenumber", scratch_path(spark, "pages"), block=4096)
    return pages.page(li.count() // 50 - 39, 50)


@register("top_lines", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) <= 3
""")
def top_lines(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return S.top_n_per_group(li, "l_orderkey", [F.col("l_extendedprice").desc(), "l_linenumber"], 3)


# U1, U3 aligned union + distinct; U2, A5, C14 id difference ---------------------------------------------------
@register("union_parties", """
SELECT DISTINCT name, nationkey, kind FROM (
  SELECT c_name AS name, c_nationkey AS nationkey, 'customer' AS kind, c_acctbal AS balance FROM customer
  UNION ALL
  SELECT s_name, s_nationkey, 'supplier', NULL FROM supplier)
""")
def union_parties(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
                                             F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
                                             F.lit("supplier").alias("kind"))
    return C.union_distinct([c.drop("balance"), s])


@register("late_customers", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderdate < DATE '1998-01-01')
""")
def late_customers(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    early = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1998, 1, 1)))
    return C.only_unknown(o, early, "o_custkey").select("o_orderkey", "o_custkey")


# F2 names in any script: no letter disappears, so different names keep different keys --------------------------------------
NAMES = ("李明", "王明", "محمد علي", "أحمد علي", "გიორგი", "ნიკოლოზ", "דוד לוי", "משה לוי", "김민준", "이서연", "やまだ", "さとう", "Արամ", "राम", "राज", "Jokić", "Dončić",
         "Łukasz", "Ωμέγα", "Иван", "สมชาย", "O’Neal Jr.", "𠀀x")


def _plain_key(name):
    """The folded key by plain Python, character by character."""
    from tempolith.functions.text import SUFFIX_WORDS, hangul_parts, spell_out
    lead, vowel, tail = hangul_parts()
    out = ""
    for ch in name:
        k = ord(ch) - 0xAC00
        out += ch if ch.isascii() else lead[k // 588] + vowel[k % 588 // 28] + tail[k % 28] if 0 <= k <= 0xD7A3 - 0xAC00 else spell_out(ch)
    words = "".join(c if c.isalnum() or c == "_" else " " for c in out.lower()).split()
    return " ".join(w for w in words if w not in SUFFIX_WORDS)


@register("folded_names", f"""
WITH n(i, name, key) AS (VALUES {", ".join(f"({i}, '{n}', '{_plain_key(n)}')" for i, n in enumerate(NAMES))})
SELECT c_custkey, name || ' ' || c_custkey AS name, key || ' ' || c_custkey AS key FROM customer JOIN n ON i = c_custkey % {len(NAMES)}
""")
def folded_names(spark, sf):
    name = F.concat_ws(" ", F.element_at(F.array(*map(F.lit, NAMES)), (F.col("c_custkey") % len(NAMES) + 1).cast("int")), F.col("c_custkey").cast("string"))
    out = table(spark, sf, "customer").select("c_custkey", name.alias("name"))
    return out.withColumn("key", TX.folded_key("name"))
