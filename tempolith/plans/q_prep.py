"""Scalar-function (F) and preparation / uncertainty (M) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempolith.functions import dates as DT
from tempolith.functions import numeric as NU
from tempolith.functions import text as TX
from tempolith.operators import prep as P
from tempolith.operators import uncertainty as U
from tempolith.operators import windows as W
from tempolith.plans.bindings import EV_ORDER, ev, ev_gaps, orders_frame, round_doubles, snap
from tempolith.plans.catalog import register
from tempolith.session import cut_lineage
from tempolith.sources.tables import table

_WS = r"'^\s+|\s+$'"


# F1, F2 name keys over whole document texts ------------------------------------------------
@register("entity_keys", rf"""
WITH d AS (SELECT doc_id, text, regexp_replace(text, {_WS}, '', 'g') AS s FROM documents),
a AS (SELECT doc_id,
             CASE WHEN strpos(s, ',') > 0
                  THEN regexp_replace(substr(s, strpos(s, ',') + 1), {_WS}, '', 'g') || ' ' ||
                       regexp_replace(substr(s, 1, strpos(s, ',') - 1), {_WS}, '', 'g')
                  ELSE s END AS s1,
             text
      FROM d)
SELECT doc_id,
       regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         regexp_replace(strip_accents(s1), '[^\x00-\x7F]', '', 'g'),
         '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'), '\b[IVX]+$', ''), {_WS}, '', 'g') AS key_ascii,
       coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(
         regexp_replace(strip_accents(replace(regexp_replace(text, '{TX.PARENTHETICAL}', ' ', 'g'), 'ß', 'ss')), '[^\x00-\x7F]', '', 'g')),
         '{TX.SUFFIXES}', ' ', 'g'), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'), {_WS}, '', 'g'), '')
         AS key_folded
FROM a
""")
def entity_keys(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", TX.entity_key("text").alias("key_ascii"), TX.folded_key("text").alias("key_folded"))


# F3 status / reason split ------------------------------------------------------------------
_STATUS_TEXT_SQL = """
CASE CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
  WHEN 1 THEN 'out' WHEN 2 THEN 'Day-to-day' WHEN 3 THEN 'questionable now'
  WHEN 4 THEN 'game-time decision' ELSE '5 pending' END
|| CASE WHEN o_orderkey % 3 = 0 THEN ' - note' ELSE ' (' || o_orderstatus || ' issue) - note' END"""


def _status_text():
    pri = F.substring("o_orderpriority", 1, 1).cast("int")
    head = (F.when(pri == 1, "out").when(pri == 2, "Day-to-day").when(pri == 3, "questionable now")
            .when(pri == 4, "game-time decision").otherwise("5 pending"))
    tail = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" - note")).otherwise(
        F.concat(F.lit(" ("), F.col("o_orderstatus"), F.lit(" issue) - note")))
    return F.concat(head, tail)


@register("status_parse", f"""
WITH t AS (SELECT o_orderkey, {_STATUS_TEXT_SQL} AS txt FROM orders),
r AS (SELECT o_orderkey, txt,
             trim(regexp_extract(trim(txt), '^([A-Za-z][A-Za-z\\- ]*?)\\s*(?:\\(|\\s-\\s|$)', 1)) AS raw,
             trim(regexp_extract(trim(txt), '\\(([^)]+)\\)', 1)) AS reason
      FROM t),
c AS (SELECT *, array_to_string(list_transform(string_split(lower(raw), ' '),
          lambda w: array_to_string(list_transform(string_split(w, '-'),
                 lambda p: upper(substr(p, 1, 1)) || substr(p, 2)), '-')), ' ') AS title FROM r)
SELECT o_orderkey,
       CASE WHEN raw = '' THEN NULL
            WHEN starts_with(lower(title), 'out') THEN 'Out'
            WHEN starts_with(lower(title), 'day-to-day') THEN 'Day-To-Day'
            WHEN starts_with(lower(title), 'questionable') THEN 'Questionable'
            ELSE title END AS status,
       CASE WHEN reason = '' THEN NULL ELSE reason END AS reason
FROM c
""")
def status_parse(spark, sf):
    o = table(spark, sf, "orders").withColumn("txt", _status_text())
    status, reason = TX.status_reason("txt")
    return o.select("o_orderkey", status.alias("status"), reason.alias("reason"))


# F4 multi-format dates ----------------------------------------------------------------------
@register("date_parse", """
WITH t AS (
  SELECT o_orderkey, o_orderdate::date AS d,
         CASE WHEN o_orderkey % 97 = 0 THEN 'not a date'
              WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
              WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%a, %b %-d, %Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt
  FROM orders)
SELECT o_orderkey,
       coalesce(try_strptime(txt, '%m/%d/%Y'),
                try_strptime(regexp_replace(txt, '^[A-Za-z]+,\\s*', ''), '%b %d, %Y'),
                try_strptime(txt, '%Y-%m-%d'))::date AS parsed
FROM t
""")
def date_parse(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    k = F.col("o_orderkey")
    txt = (F.when(k % 97 == 0, F.lit("not a date"))
           .when(k % 3 == 0, F.date_format("d", "M/d/yyyy"))
           .when(k % 3 == 1, F.date_format("d", "EEE, MMM d, yyyy"))
           .otherwise(F.date_format("d", "yyyy-MM-dd")))
    return o.select("o_orderkey", DT.parse_date(txt).alias("parsed"))


# F5, F6, F7 season fields ----------------------------------------------------------------------
@register("season_fields", """
WITH o AS (SELECT o_orderkey, o_orderdate::date AS d FROM orders),
s AS (SELECT o_orderkey, d, CAST(CASE WHEN month(d) >= 10 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS season FROM o)
SELECT o_orderkey, season,
       printf('%d-%02d', season, (season + 1) % 100) AS season_label,
       d >= make_date(season + 1, 4, 12) AND d < make_date(season + 1, 10, 1) AS post_season,
       strftime(d, '%m%d') BETWEEN '1021' AND '1231' OR strftime(d, '%m%d') BETWEEN '0101' AND '0622' AS in_season
FROM s
""")
def season_fields(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", DT.season_start("d").alias("season"), DT.season_label("d").alias("season_label"),
                    DT.is_post_season("d").alias("post_season"), DT.in_season_window("d").alias("in_season"))


# F8-F10, F13-F17 numeric expressions -----------------------------------------------------------
@register("numeric_exprs", """
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_tax, l_discount, l_extendedprice, l_quantity,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS q,
         CASE WHEN l_linenumber = 7 THEN 'None'
              ELSE (CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '' END) || CAST(l_linenumber - 3 AS VARCHAR) END AS pm,
         CASE WHEN l_linenumber = 5 THEN 'even' ELSE CAST(CAST((l_quantity - 25) * 10 AS BIGINT) AS VARCHAR) END AS odds
  FROM lineitem)
SELECT l_orderkey, l_linenumber,
       SNAP(l_tax / nullif(l_discount, 0)) AS tax_per_discount,
       CASE WHEN q IS NULL THEN NULL ELSE least(greatest(q, 5.0), 40.0) END AS q_clipped,
       TRY_CAST(regexp_replace(trim(pm), '^\\+', '') AS DOUBLE) AS plus_minus,
       CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'other' END AS flag_label,
       round_even(l_extendedprice / 7 + 0.001, 1) AS price_7th,
       SNAP(CASE WHEN TRY_CAST(odds AS DOUBLE) < 0 THEN abs(TRY_CAST(odds AS DOUBLE)) / (abs(TRY_CAST(odds AS DOUBLE)) + 100) * 100
                 WHEN TRY_CAST(odds AS DOUBLE) IS NOT NULL THEN 100 / (TRY_CAST(odds AS DOUBLE) + 100) * 100 END) AS implied_pct,
       SNAP(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END) AS finite_ratio,
       CAST(CASE WHEN q IS NULL OR l_discount = 0 THEN 1 ELSE 0 END AS INTEGER) AS any_missing
FROM l
""")
def numeric_exprs(spark, sf):
    li = table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    li = li.withColumns({
        "q": F.when(ln != 3, F.col("l_quantity")),
        "pm": F.when(ln == 7, F.lit("None")).otherwise(
            F.concat(F.when(ln % 2 == 0, F.lit("+")).otherwise(F.lit("")), (ln - 3).cast("string"))),
        "odds": F.when(ln == 5, F.lit("even")).otherwise(((F.col("l_quantity") - 25) * 10).cast("long").cast("string")),
        "disc_or_null": F.when(F.col("l_discount") != 0, F.col("l_discount")),
        "raw_ratio": F.when(F.col("l_discount") == 0, F.lit(float("inf")))
                      .otherwise(F.try_divide(F.col("l_tax"), F.col("l_discount")))})
    out = li.select(
        "l_orderkey", "l_linenumber",
        snap(NU.safe_ratio("l_tax", "l_discount")).alias("tax_per_discount"),
        NU.clip("q", 5.0, 40.0).alias("q_clipped"),
        TX.signed_number("pm").alias("plus_minus"),
        TX.recode("l_returnflag", {"A": "accepted", "R": "returned"}, default="other").alias("flag_label"),
        # (x/7 + 0.001 is never an exact one-decimal tie; engines break ties of binary doubles differently)
        F.bround(F.col("l_extendedprice") / 7 + 0.001, 1).alias("price_7th"),
        snap(NU.implied_probability("odds")).alias("implied_pct"),
        snap(NU.finite_or_null("raw_ratio")).alias("finite_ratio"),
        NU.any_missing(["q", "disc_or_null"]).alias("any_missing"))
    return out


# F11 text cleanup over raw pages ------------------------------------------------------------------
@register("text_cleanup", r"""
SELECT page_id,
       CAST(length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))) AS INTEGER) AS n_text_chars,
       CAST(len(string_split(lower(html), '<a ')) - 1 AS BIGINT) AS n_links,
       'https://' || regexp_extract(url, '^https?://([^/?#]+)', 1) || '/' AS site,
       upper(substr(lower(regexp_extract(url, '/(en|fr|de|es)/', 1)), 1, 1)) || substr(lower(regexp_extract(url, '/(en|fr|de|es)/', 1)), 2) AS lang_label
FROM pages
""")
def text_cleanup(spark, sf):
    p = table(spark, sf, "pages")
    clean = TX.squish(TX.strip_tags("html"))
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    lang = F.regexp_extract("url", r"/(en|fr|de|es)/", 1)
    return p.select("page_id", F.length(clean).alias("n_text_chars"),
                    (TX.count_substring(F.lower("html"), "<a ") * 1).cast("long").alias("n_links"),
                    F.concat(F.lit("https://"), host, F.lit("/")).alias("site"),
                    TX.sentence_case(lang).alias("lang_label"))


# M1 temporal split -------------------------------------------------------------------------------
@register("temporal_split", """
SELECT CASE WHEN year(o_orderdate) < 2000 THEN 'train' ELSE 'valid' END AS split,
       count(*) AS n, SNAP12(avg(o_totalprice)) AS avg_price
FROM orders WHERE year(o_orderdate) <= 2000 GROUP BY 1
""")
def temporal_split(spark, sf):
    o = orders_frame(spark, sf, customer=False)
    train, valid = P.temporal_split(o, "season", 2000)
    both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    out = both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("avg_price"))
    return out.withColumn("avg_price", snap("avg_price", 12))


# M2, M3 category index with unseen -> 0, embedding sizes --------------------------------------------
_CAT_SQL = """
o AS (SELECT o_orderkey, year(o_orderdate) AS season, o_totalprice, CAST(o_custkey AS VARCHAR) AS cat FROM orders),
tr AS (SELECT * FROM o WHERE season < 1996),
va AS (SELECT * FROM o WHERE season = 2000),
ix AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) AS INTEGER) AS cat_idx FROM (SELECT DISTINCT cat FROM tr))"""


def _cat_frames(spark, sf):
    o = orders_frame(spark, sf, customer=False).withColumn("cat", F.col("o_custkey").cast("string"))
    # fitted on the first season, so later ones hold categories it does not know
    train, _ = P.temporal_split(o, "season", 1996)
    _, valid = P.temporal_split(o, "season", 2000)
    idx = P.fit_index(train, "cat")
    return train, valid, idx


@register("category_index", f"""
WITH {_CAT_SQL}
SELECT va.o_orderkey, coalesce(ix.cat_idx, 0) AS cat_idx FROM va LEFT JOIN ix USING (cat)
""")
def category_index(spark, sf):
    train, valid, idx = _cat_frames(spark, sf)
    return P.apply_index(valid, idx, "cat").select("o_orderkey", "cat_idx")


@register("index_stats", f"""
WITH {_CAT_SQL},
ap AS (SELECT coalesce(ix.cat_idx, 0) AS cat_idx FROM va LEFT JOIN ix USING (cat))
SELECT 'cat' AS feature, (SELECT count(*) FROM ix) AS n_seen, (SELECT count(*) FROM ix) + 1 AS num_embeddings,
       CAST(least(50, greatest(4, floor(sqrt((SELECT count(*) FROM ix) + 1)))) AS INTEGER) AS embedding_dim,
       SNAP((SELECT avg(CASE WHEN cat_idx = 0 THEN 1.0 ELSE 0.0 END) FROM ap)) AS unknown_rate
""")
def index_stats(spark, sf):
    train, valid, idx = _cat_frames(spark, sf)
    st = P.index_stats(idx, P.apply_index(valid, idx, "cat"), "cat")
    return st.withColumn("unknown_rate", snap("unknown_rate"))


# M4, M5 standardisation with population std; priors NULL -> 0 ----------------------------------------
@register("standardize", """
WITH g AS (SELECT event_id, value, CASE WHEN event_id % 7 <> 0 THEN value END AS prior FROM events),
p AS (SELECT avg(value) AS m, stddev_pop(value) AS s, avg(coalesce(prior, 0)) AS pm, stddev_pop(coalesce(prior, 0)) AS ps FROM g)
SELECT event_id, SNAP((value - m) / CASE WHEN s > 0 THEN s ELSE 1 END) AS value,
       SNAP((coalesce(prior, 0) - pm) / CASE WHEN ps > 0 THEN ps ELSE 1 END) AS prior,
       SNAP(((value - m) / CASE WHEN s > 0 THEN s ELSE 1 END) * CASE WHEN s > 0 THEN s ELSE 1 END + m) AS value_back
FROM g, p
""")
def standardize(spark, sf):
    e = ev(spark, sf).select("event_id", "value",
                             F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("prior"))
    params = P.fit_scaler(e, ["value"])
    z = P.scale(e, params, ["value"])
    z = P.prepare_priors(e, z, ["prior"])
    back = P.scale(z.select("event_id", F.col("value").alias("v")).withColumnRenamed("v", "value"),
                   params, ["value"], inverse=True).withColumnRenamed("value", "value_back")
    return round_doubles(z.select("event_id", "value", "prior").join(back, "event_id"))


# M6 exact median imputation (PCA part is rows-only below) ---------------------------------------------
@register("median_impute", """
WITH g AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
SELECT event_id, SNAP(coalesce(value, (SELECT median(value) FROM g))) AS value FROM g
""")
def median_impute(spark, sf):
    g = ev_gaps(spark, sf).select("event_id", "value")
    return round_doubles(P.median_impute(g, g, ["value"]))


# of two standardised columns the components are (1, 1) and (1, -1), over the root of 2; scores are squared, their signs are arbitrary
@register("pca_reduce", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice END AS b, l_shipdate FROM lineitem),
md AS (SELECT median(a) AS ma, median(b) AS mb FROM l WHERE l_shipdate < TIMESTAMP '1999-01-01'),
f AS (SELECT l_orderkey, l_linenumber, coalesce(a, ma) AS a, coalesce(b, mb) AS b, l_shipdate FROM l, md),
p AS (SELECT avg(a) AS aa, stddev_pop(a) AS sa, avg(b) AS ab, stddev_pop(b) AS sb, corr(a, b) AS r FROM f WHERE l_shipdate < TIMESTAMP '1999-01-01'),
z AS (SELECT l_orderkey, l_linenumber, (a - aa) / sa AS x, (b - ab) / sb AS y, r FROM f, p)
SELECT l_orderkey, l_linenumber, CASE WHEN (1 + abs(r)) / 2 >= 0.95 THEN 1 ELSE 2 END AS k,
       SNAP12(pow(x + sign(r) * y, 2) / 2) AS pc1_squared FROM z
""")
def pca_reduce(spark, sf):
    from pyspark.ml.functions import vector_to_array
    cols = ["l_quantity", "l_extendedprice"]
    li = table(spark, sf, "lineitem").withColumn("l_extendedprice", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_extendedprice")))
    train = li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))   # fit on earlier lines
    out, k = P.prepare_numeric(train, li, cols, variance=0.95)
    first = F.element_at(vector_to_array("pca"), 1)
    return out.select("l_orderkey", "l_linenumber", F.lit(k).alias("k"), snap(first * first, 12).alias("pc1_squared"))


# M7 one-hot from train categories -------------------------------------------------------------------
@register("one_hot", """
WITH o AS (SELECT o.o_orderkey, year(o.o_orderdate) AS season, c.c_mktsegment,
                  CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'yes' ELSE 'no' END AS urgent
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT o_orderkey,
       CAST(c_mktsegment = 'AUTOMOBILE' AS DOUBLE) AS c_mktsegment_AUTOMOBILE,
       CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS c_mktsegment_BUILDING,
       CAST(c_mktsegment = 'FURNITURE' AS DOUBLE) AS c_mktsegment_FURNITURE,
       CAST(c_mktsegment = 'HOUSEHOLD' AS DOUBLE) AS c_mktsegment_HOUSEHOLD,
       CAST(c_mktsegment = 'MACHINERY' AS DOUBLE) AS c_mktsegment_MACHINERY,
       CAST(urgent = 'yes' AS DOUBLE) AS urgent_yes
FROM o WHERE season = 2000
""")
def one_hot(spark, sf):
    o = orders_frame(spark, sf).withColumn(
        "urgent", F.when(F.col("o_orderpriority") == "1-URGENT", "yes").otherwise("no"))
    train, valid = P.temporal_split(o, "season", 2000)
    out = P.one_hot(train, valid, "c_mktsegment")
    out = P.one_hot(train, out, "urgent")
    return out.select("o_orderkey", *[c for c in out.columns if c.startswith("c_mktsegment_") or c.startswith("urgent_")])


# M8 variance filter ------------------------------------------------------------------------------------
@register("variance_filter", """
SELECT l_discount, l_tax, l_quantity FROM lineitem
""")
def variance_filter(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("disc_pct_small", F.col("l_discount") / 100)
    keep = P.variance_filter(li, ["l_discount", "l_tax", "disc_pct_small", "l_quantity"], 1e-4)
    return li.select(*keep)


# M10 prior dampener -----------------------------------------------------------------------------------
@register("dampen_priors", """
WITH f AS (
  SELECT event_id, value,
         avg(value) OVER w AS em, stddev_samp(value) OVER w AS es,
         CASE WHEN count(value) OVER w5 = 5 THEN avg(value) OVER w5 END AS rm
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w5 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
r AS (SELECT *,
        CASE WHEN rm IS NULL THEN NULL ELSE least(greatest(rm / (em + 1e-6), 0.2), 1.0) END AS mr,
        least(greatest(coalesce(rm / nullif(em, 0), 1.0), 0.2), 1.0) AS pr FROM f),
w AS (SELECT *, CASE WHEN mr IS NULL THEN NULL ELSE least(mr, pr) END AS wt FROM r)
SELECT event_id, SNAP(em * wt) AS value_exp_mean, SNAP(es * (2 - wt)) AS value_exp_std FROM w
""")
def dampen_priors(spark, sf):
    e = W.expanding(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    e = W.rolling(e, ["value"], "user_id", EV_ORDER)
    e = P.dampen(e, ["value"], "value_roll_mean", "value_exp_mean", recent_fmt="{t}_roll_mean")
    return round_doubles(e.select("event_id", "value_exp_mean", "value_exp_std"))


# M11 breakout label, M12 class-balance weights ---------------------------------------------------------
@register("breakout_weights", """
WITH f AS (
  SELECT event_id, event_type, value,
         avg(value) OVER w + stddev_samp(value) OVER w AS tau
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CASE WHEN tau IS NOT NULL THEN 1 ELSE 0 END AS valid,
             CASE WHEN tau IS NOT NULL AND value > tau THEN 1 ELSE 0 END AS breakout FROM f),
p AS (SELECT *, least(greatest(sum(breakout * valid) OVER (PARTITION BY event_type)
                   / greatest(sum(valid) OVER (PARTITION BY event_type), 1), 1e-6), 1 - 1e-6) AS pos FROM l)
SELECT event_id, breakout, valid AS breakout_valid,
       SNAP((breakout * (1 - pos) + (1 - breakout) * pos) * valid) AS weight
FROM p
""")
def breakout_weights(spark, sf):
    e = W.expanding(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    e = P.breakout_label(e, "value", "value_exp_mean", "value_exp_std")
    e = P.balance_weights(e, "event_type", "breakout", "breakout_valid")
    return round_doubles(e.select("event_id", "breakout", "breakout_valid", "weight"))


# M13 deterministic hash split -------------------------------------------------------------------------------
@register("hash_split", """
SELECT event_id, user_id, ('0x' || substr(md5('42:' || event_id), 1, 12))::BIGINT % 1048576 < 524288 AS is_cal FROM events
""")
def hash_split(spark, sf):
    e = P.hash_split(table(spark, sf, "events").select("event_id", "user_id"), "event_id", 0.5, seed=42)
    return e


# M15 draw summaries --------------------------------------------------------------------------------------
_DRAWS_SQL = """
d AS (SELECT user_id, event_type AS target, value AS mean, ln(1 + value) AS logvar, value AS sample FROM events),
sm AS (SELECT user_id, target, avg(mean) AS mean_pred, stddev_pop(mean) AS std_epistemic,
              sqrt(avg(exp(logvar))) AS std_aleatoric,
              quantile_cont(sample, 0.1) AS q10, quantile_cont(sample, 0.5) AS q50, quantile_cont(sample, 0.9) AS q90
       FROM d GROUP BY ALL)"""


def _draw_summary(spark, sf):
    d = table(spark, sf, "events").select("user_id", F.col("event_type").alias("target"),
                                          F.col("value").alias("mean"), F.log1p("value").alias("logvar"),
                                          F.col("value").alias("sample"))
    return U.summarize_draws(d, ["user_id", "target"])


@register("draw_summary", f"""
WITH {_DRAWS_SQL}
SELECT user_id, target, SNAP(mean_pred) AS mean_pred, SNAP(std_epistemic) AS std_epistemic,
       SNAP(std_aleatoric) AS std_aleatoric, SNAP(sqrt(std_epistemic ^ 2 + std_aleatoric ^ 2)) AS std_predictive,
       SNAP(q10) AS q10, SNAP(q50) AS q50, SNAP(q90) AS q90
FROM sm
""")
def draw_summary(spark, sf):
    return round_doubles(_draw_summary(spark, sf))


# M16, M17 calibration scales ----------------------------------------------------------------------------
_GRID_SQL = "grid AS (SELECT CASE WHEN j = 90 THEN 3.0 ELSE j * ((3.0 - 0.3) / 90) + 0.3 END AS s FROM range(91) t(j))"
_EXP_SQL = """
f AS (SELECT event_type, value AS y,
             avg(value) OVER w AS mu, 0.3 * stddev_samp(value) OVER w AS se, stddev_samp(value) OVER w AS sa,
             CASE WHEN count(value) OVER w5 = 5 THEN avg(value) OVER w5 END AS q50,
             CASE WHEN count(value) OVER w5 = 5 THEN min(value) OVER w5 END AS qlo,
             CASE WHEN count(value) OVER w5 = 5 THEN max(value) OVER w5 END AS qhi
      FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             w5 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))"""


def _calib_frame(spark, sf):
    e = W.expanding(ev(spark, sf), ["value"], "user_id", EV_ORDER)
    e = W.rolling(e, ["value"], "user_id", EV_ORDER)
    return e.select("event_type", F.col("value").alias("y"), F.col("value_exp_mean").alias("mu"),
                    (F.lit(0.3) * F.col("value_exp_std")).alias("se"), F.col("value_exp_std").alias("sa"),
                    F.col("value_roll_mean").alias("q50"), F.col("value_roll_min").alias("qlo"),
                    F.col("value_roll_max").alias("qhi"))


@register("std_scale_fit", f"""
WITH {_GRID_SQL}, {_EXP_SQL},
c AS (SELECT f.event_type, g.s,
             avg(CASE WHEN y >= mu - 1.2815515655446004 * sqrt(se ^ 2 + (g.s * sa) ^ 2)
                       AND y <= mu + 1.2815515655446004 * sqrt(se ^ 2 + (g.s * sa) ^ 2) THEN 1.0 ELSE 0.0 END) AS cov
      FROM f CROSS JOIN grid g GROUP BY ALL),
b AS (SELECT event_type, min(abs(cov - 0.8)) AS best FROM c GROUP BY event_type)
SELECT c.event_type, SNAP(min(c.s)) AS s FROM c JOIN b ON c.event_type = b.event_type AND abs(c.cov - 0.8) = b.best
GROUP BY c.event_type
""")
def std_scale_fit(spark, sf):
    c = _calib_frame(spark, sf)
    return round_doubles(U.fit_std_scale(c, "event_type", "y", "mu", "se", "sa"))


@register("quantile_scale_fit", f"""
WITH {_GRID_SQL}, {_EXP_SQL},
c AS (SELECT f.event_type, g.s,
             avg(CASE WHEN y >= q50 + g.s * (qlo - q50) AND y <= q50 + g.s * (qhi - q50) THEN 1.0 ELSE 0.0 END) AS cov
      FROM f CROSS JOIN grid g GROUP BY ALL),
b AS (SELECT event_type, min(abs(cov - 0.8)) AS best FROM c GROUP BY event_type)
SELECT c.event_type, SNAP(min(c.s)) AS s FROM c JOIN b ON c.event_type = b.event_type AND abs(c.cov - 0.8) = b.best
GROUP BY c.event_type
""")
def quantile_scale_fit(spark, sf):
    c = _calib_frame(spark, sf)
    return round_doubles(U.fit_quantile_scale(c, "event_type", "y", "q50", "qlo", "qhi"))


# M18 calibrated intervals, M19 evaluation, M20 metrics view, M21 wide display ------------------------------
_EVAL_SQL = f"""{_DRAWS_SQL},
yv AS (SELECT user_id, event_type AS target, arg_max(value, event_id) AS y FROM events GROUP BY ALL),
{_GRID_SQL},
qc AS (SELECT sm.target, g.s,
              avg(CASE WHEN yv.y >= sm.q50 + g.s * (sm.q10 - sm.q50) AND yv.y <= sm.q50 + g.s * (sm.q90 - sm.q50)
                       THEN 1.0 ELSE 0.0 END) AS cov
       FROM sm JOIN yv USING (user_id, target) CROSS JOIN grid g GROUP BY ALL),
qb AS (SELECT target, min(abs(cov - 0.8)) AS best FROM qc GROUP BY target),
qs AS (SELECT qc.target, min(qc.s) AS qs FROM qc JOIN qb ON qc.target = qb.target AND abs(qc.cov - 0.8) = qb.best GROUP BY qc.target),
yp AS (SELECT event_type AS target, avg(value) AS y_mean FROM events GROUP BY 1),
iv AS (
  SELECT sm.user_id, sm.target, yv.y,
         sm.mean_pred + yp.y_mean AS mu,
         sm.q50 + yp.y_mean AS q50,
         sm.q50 + (sm.q10 - sm.q50) * qs.qs + yp.y_mean AS q10,
         sm.q50 + (sm.q90 - sm.q50) * qs.qs + yp.y_mean AS q90,
         sqrt(sm.std_epistemic ^ 2 + sm.std_aleatoric ^ 2) AS sp, sm.std_epistemic AS se, sm.std_aleatoric AS sa
  FROM sm JOIN yv USING (user_id, target) JOIN qs USING (target) JOIN yp USING (target)),
ivc AS (
  SELECT user_id, target, y, se, sa, sp,
         CASE WHEN mu IS NULL THEN NULL ELSE greatest(mu, 0) END AS mu,
         CASE WHEN q10 IS NULL THEN NULL ELSE greatest(q10, 0) END AS q10,
         CASE WHEN q50 IS NULL THEN NULL ELSE greatest(q50, 0) END AS q50,
         CASE WHEN q90 IS NULL THEN NULL ELSE greatest(q90, 0) END AS q90,
         greatest(mu - 1.2815515655446004 * sp, 0) AS std80_lower,
         mu + 1.2815515655446004 * sp AS std80_upper
  FROM iv)"""


def _eval_frame(spark, sf):
    s = _draw_summary(spark, sf)
    e = table(spark, sf, "events")
    y = e.groupBy("user_id", F.col("event_type").alias("target")).agg(F.max_by("value", "event_id").alias("y"))
    j = s.join(y, ["user_id", "target"])
    qs = U.fit_quantile_scale(j, "target", "y", "q50", "q10", "q90")
    yp = e.groupBy(F.col("event_type").alias("target")).agg(F.avg("value").alias("y_mean")).withColumn("y_scale", F.lit(1.0))
    return U.intervals(j, "target", q_scale=qs, y_params=yp, center="median")


@register("calibrated_intervals", f"""
WITH {_EVAL_SQL}
SELECT user_id, target, SNAP(mu) AS mean_pred, SNAP(q10) AS q10, SNAP(q50) AS q50, SNAP(q90) AS q90,
       SNAP(std80_lower) AS std80_lower, SNAP(std80_upper) AS std80_upper,
       SNAP(greatest(q90 - q10, 0)) AS pi80_width
FROM ivc
""")
def calibrated_intervals(spark, sf):
    iv = _eval_frame(spark, sf)
    return round_doubles(iv.select("user_id", "target", "mean_pred", "q10", "q50", "q90",
                                   "std80_lower", "std80_upper", "pi80_width"))


_METRICS_SQL = """
SELECT target, '{suffix}' AS suffix,
       SNAP(sqrt(avg((mu - y) ^ 2))) AS rmse_mean, SNAP(avg(abs(mu - y))) AS mae_mean,
       SNAP(1 - sum((mu - y) ^ 2) / (var_pop(y) * count(*))) AS r2,
       SNAP(sqrt(avg((q50 - y) ^ 2))) AS rmse_median, SNAP(avg(abs(q50 - y))) AS mae_median,
       SNAP(avg(greatest(0.1 * (y - q10), -0.9 * (y - q10)))) AS pinball_10,
       SNAP(avg(greatest(0.5 * (y - q50), -0.5 * (y - q50)))) AS pinball_50,
       SNAP(avg(greatest(0.9 * (y - q90), -0.1 * (y - q90)))) AS pinball_90,
       SNAP(avg(CASE WHEN y >= q10 AND y <= q90 THEN 1.0 ELSE 0.0 END)) AS pi80_coverage,
       SNAP(avg(q90 - q10)) AS pi80_width,
       SNAP(avg(CASE WHEN y < q10 THEN 1.0 ELSE 0.0 END)) AS below_q10_rate,
       SNAP(avg(CASE WHEN y > q90 THEN 1.0 ELSE 0.0 END)) AS above_q90_rate,
       SNAP(avg(CASE WHEN y > q50 THEN 1.0 ELSE 0.0 END)) AS above_q50_rate,
       SNAP(avg(CASE WHEN y >= mu - 1.2815515655446004 * sp AND y <= mu + 1.2815515655446004 * sp THEN 1.0 ELSE 0.0 END)) AS std80_coverage,
       SNAP(avg(mu - y)) AS bias,
       SNAP(CASE WHEN stddev_pop(sp) > 0 AND stddev_pop(abs(mu - y)) > 0 THEN corr(sp, abs(mu - y)) END) AS uncert_error_corr,
       SNAP(avg(sp)) AS std_predictive_mean, SNAP(avg(se)) AS std_epistemic_mean, SNAP(avg(sa)) AS std_aleatoric_mean
FROM ivc GROUP BY target"""


@register("evaluation_table", f"WITH {_EVAL_SQL}\n" + _METRICS_SQL.format(suffix="cal"))
def evaluation_table(spark, sf):
    iv = _eval_frame(spark, sf)
    return round_doubles(U.evaluate(iv, "target", "y", "cal"))


@register("metrics_view", f"""
WITH {_EVAL_SQL}, m AS ({_METRICS_SQL.format(suffix='cal')})
SELECT CASE target WHEN 'click' THEN 'Clicks' WHEN 'view' THEN 'Views' ELSE target END AS target,
       suffix, rmse_mean, pi80_coverage, bias
FROM m
""")
def metrics_view(spark, sf):
    iv = _eval_frame(spark, sf)
    cal = U.evaluate(iv, "target", "y", "cal")
    raw = U.evaluate(_draw_summary(spark, sf).join(
        table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("target"))
        .agg(F.max_by("value", "event_id").alias("y")), ["user_id", "target"]), "target", "y", "uncal")
    v = U.metrics_view(cal, raw, "target", use="cal", labels={"click": "Clicks", "view": "Views"})
    return round_doubles(v.select("target", "suffix", "rmse_mean", "pi80_coverage", "bias"))


# every target and measure of the published layout
_LAYOUT = ("click", "error", "purchase", "signup", "view")
_MEASURES = {"mean_pred": "mu", "q10": "q10", "q50": "q50", "q90": "q90", "std80_lower": "std80_lower", "std80_upper": "std80_upper", "pi80_width": "greatest(q90 - q10, 0)",
             "std_predictive": "sp", "std_epistemic": "se", "std_aleatoric": "sa"}


@register("display_wide", f"""
WITH {_EVAL_SQL}
SELECT user_id, {", ".join(f"max(CASE WHEN target = '{t}' THEN SNAP({e}) END) AS {t}_{m}" for t in _LAYOUT for m, e in _MEASURES.items())}
FROM ivc GROUP BY user_id
""")
def display_wide(spark, sf):
    iv = round_doubles(_eval_frame(spark, sf).select("user_id", "target", *_MEASURES))
    return U.display_table(iv, ["user_id"], "target", _LAYOUT, list(_MEASURES))


# M14 bagged regressors standing in for MC draws: hashed weights and noise, so SQL can repeat them ---------------
_MEMBERS = 4
_U = "(('0x' || substr(md5({}), 1, 12))::BIGINT + 0.5) / 281474976710656.0"
_POISSON = "CASE " + " ".join(f"WHEN u < {c!r} THEN {k}.0" for k, c in enumerate(U.poisson1_steps())) + f" ELSE {len(U.poisson1_steps())}.0 END"


@register("ensemble_draws", f"""
WITH q AS (SELECT l_orderkey, sum(l_quantity) AS x FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS row_, o_orderdate, coalesce(q.x, 0) / 100 AS x, o_totalprice / 100000 AS y FROM orders LEFT JOIN q ON l_orderkey = o_orderkey),
tr AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
mm AS (SELECT CAST(m AS INTEGER) AS m FROM range(0, {_MEMBERS}) t(m)),
wt AS (SELECT tr.*, m, {_U.format("'7:' || row_ || ':' || m")} AS u FROM tr, mm),
w AS (SELECT *, {_POISSON} AS w FROM wt),
b AS (SELECT m, (sum(w) * sum(w * x * y) - sum(w * x) * sum(w * y)) / (sum(w) * sum(w * x * x) - sum(w * x) ^ 2) AS slope,
             sum(w * x) AS sx, sum(w * y) AS sy, sum(w) AS sw FROM w GROUP BY m),
c AS (SELECT m, slope, (sy - slope * sx) / sw AS icpt FROM b),
lv AS (SELECT m, ln(avg((y - icpt - slope * x) ^ 2)) AS logvar FROM tr, c GROUP BY m),
d AS (SELECT o.row_, m, icpt + slope * x AS mean, logvar,
             {_U.format("'7:radius:' || row_ || ':y:' || m")} AS u, {_U.format("'7:angle:' || row_ || ':y:' || m")} AS v
      FROM o, c JOIN lv USING (m)),
e AS (SELECT *, mean + exp(logvar / 2) * sqrt(-2 * ln(u)) * cos(2 * pi() * v) AS sample FROM d),
s AS (SELECT row_, avg(mean) AS mean_pred, stddev_pop(mean) AS se, sqrt(avg(exp(logvar))) AS sa,
             quantile_cont(sample, 0.1) AS q10, quantile_cont(sample, 0.5) AS q50, quantile_cont(sample, 0.9) AS q90 FROM e GROUP BY row_)
SELECT row_ AS o_orderkey, 'y' AS target, SNAP12(mean_pred) AS mean_pred, SNAP12(se) AS std_epistemic, SNAP12(sa) AS std_aleatoric,
       SNAP12(sqrt(se ^ 2 + sa ^ 2)) AS std_predictive, SNAP12(q10) AS q10, SNAP12(q50) AS q50, SNAP12(q90) AS q90 FROM s
""")
def ensemble_draws(spark, sf):
    qty = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"))
    o = table(spark, sf, "orders").join(qty, "o_orderkey", "left").select(
        "o_orderkey", "o_orderdate", (F.coalesce("qty", F.lit(0.0)) / 100).alias("x"), (F.col("o_totalprice") / 100000).alias("y"))
    # fit on the orders before 1999, score every order
    train = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    fitted = U.fit_ensemble(train, "o_orderkey", ["x"], ["y"], members=_MEMBERS)
    draws = U.score_draws(o, "o_orderkey", ["x"], fitted)
    return round_doubles(U.summarize_draws(draws, ["o_orderkey", "target"]), bits=12)


# M14 row-dependent variance: log squares of out-of-bag residuals on the feature, shifted to a mean ratio of 1 -----------
_ORDERS_XY = """
q AS (SELECT l_orderkey, sum(l_quantity) AS x FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS row_, o_custkey, o_orderdate, coalesce(q.x, 0) / 100 AS x, o_totalprice / 100000 AS price,
             CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS urgent FROM orders LEFT JOIN q ON l_orderkey = o_orderkey),
tr AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01')"""


def _orders_xy(spark, sf):
    qty = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"))
    o = table(spark, sf, "orders").join(qty, "o_orderkey", "left").select(
        "o_orderkey", "o_custkey", "o_orderdate", (F.coalesce("qty", F.lit(0.0)) / 100).alias("x"), (F.col("o_totalprice") / 100000).alias("price"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"))
    return o, F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")


def _members_sql(t):
    """Members of one target: slope and intercept of the mean (c) and of the log-variance (g), and its constant."""
    return f"""
wt_{t} AS (SELECT tr.*, m, {_U.format("'7:' || row_ || ':' || m")} AS u FROM tr, mm),
w_{t} AS (SELECT *, {_POISSON} AS w FROM wt_{t}),
b_{t} AS (SELECT m, (sum(w) * sum(w * x * {t}) - sum(w * x) * sum(w * {t})) / (sum(w) * sum(w * x * x) - sum(w * x) ^ 2) AS slope,
             sum(w * x) AS sx, sum(w * {t}) AS sy, sum(w) AS sw FROM w_{t} GROUP BY m),
c_{t} AS (SELECT m, slope, (sy - slope * sx) / sw AS icpt FROM b_{t}),
k_{t} AS (SELECT m, ln(avg(({t} - icpt - slope * x) ^ 2)) AS constant FROM tr, c_{t} GROUP BY m),
e_{t} AS (SELECT m, x, {t} - icpt - slope * x AS e FROM w_{t} JOIN c_{t} USING (m) WHERE w = 0),
l_{t} AS (SELECT m, x, e, ln(greatest(e * e, 1e-12)) AS l FROM e_{t}),
h_{t} AS (SELECT m, regr_slope(l, x) AS gs, regr_intercept(l, x) AS gi FROM l_{t} GROUP BY m),
g_{t} AS (SELECT m, gs, any_value(gi) + ln(avg(e * e / exp(gi + gs * x))) AS gi FROM l_{t} JOIN h_{t} USING (m) GROUP BY m, gs),
d_{t} AS (SELECT o.*, m, icpt + slope * x AS mean, greatest(least(gi + gs * x, constant + 5), constant - 5) AS logvar
          FROM o, c_{t} JOIN g_{t} USING (m) JOIN k_{t} USING (m))"""


@register("ensemble_variance", f"""
WITH {_ORDERS_XY}, mm AS (SELECT CAST(m AS INTEGER) AS m FROM range(0, {_MEMBERS}) t(m)), {_members_sql("price")}, {_members_sql("urgent")},
d AS (SELECT row_, 'price' AS target, mean, logvar FROM d_price UNION ALL SELECT row_, 'urgent', mean, logvar FROM d_urgent)
SELECT row_ AS o_orderkey, target, SNAP12(avg(mean)) AS mean_pred, SNAP12(stddev_pop(mean)) AS std_epistemic, SNAP12(sqrt(avg(exp(logvar)))) AS std_aleatoric
FROM d GROUP BY row_, target
""")
def ensemble_variance(spark, sf):
    from tempolith.operators import ensemble as EN
    o, before = _orders_xy(spark, sf)
    model = EN.fit(o.filter(before), "o_orderkey", ["x"], ["price", "urgent"], linear=_MEMBERS, trees=0)
    s = U.summarize_draws(EN.draws(o, "o_orderkey", model), ["o_orderkey", "target"])
    return round_doubles(s.select("o_orderkey", "target", "mean_pred", "std_epistemic", "std_aleatoric"), bits=12)


# M14 blend: the share of the prediction against a customer's earlier mean, fitted on the orders since 1999 --------------
@register("ensemble_blend", f"""
WITH {_ORDERS_XY}, mm AS (SELECT CAST(m AS INTEGER) AS m FROM range(0, {_MEMBERS}) t(m)), {_members_sql("price")}, {_members_sql("urgent")},
pr AS (SELECT o_custkey, avg(price) AS p_price, avg(urgent) AS p_urgent FROM tr GROUP BY 1),
mu AS (SELECT row_, o_custkey, 'price' AS target, avg(mean) AS pred, any_value(price) AS y FROM d_price WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2
       UNION ALL SELECT row_, o_custkey, 'urgent', avg(mean), any_value(urgent) FROM d_urgent WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2),
j AS (SELECT target, y, pred, CASE target WHEN 'price' THEN p_price ELSE p_urgent END AS prior, row_ FROM mu JOIN pr USING (o_custkey)),
own AS (SELECT target, greatest(least(sum((y - prior) * (pred - prior)) / sum((pred - prior) ^ 2), 1), 0) AS own, count(*) AS n FROM j GROUP BY 1)
SELECT target, own.own, n, avg((y - own.own * pred - (1 - own.own) * prior) ^ 2) AS mse FROM j JOIN own USING (target) GROUP BY ALL
""")
def ensemble_blend(spark, sf):
    from tempolith.operators import ensemble as EN
    o, before = _orders_xy(spark, sf)
    model = EN.fit(o.filter(before), "o_orderkey", ["x"], ["price", "urgent"], linear=_MEMBERS, trees=0)
    prior = o.filter(before).groupBy("o_custkey").agg(F.avg("price").alias("p_price"), F.avg("urgent").alias("p_urgent"))
    late = o.filter(~before).join(prior, "o_custkey")
    priors = {"price": "p_price", "urgent": "p_urgent"}
    model = EN.with_blend(model, late, "o_orderkey", priors)
    mean = EN.draws(late, "o_orderkey", model, priors=priors).groupBy("o_orderkey", "target").agg(F.avg("mean").alias("blended"))
    y = late.unpivot(["o_orderkey"], ["price", "urgent"], "target", "y")
    own = spark.createDataFrame(list(model.own.items()), "target string, own double")
    return mean.join(y, ["o_orderkey", "target"]).groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.pow(F.col("y") - F.col("blended"), 2)).alias("mse")).join(own, "target").select("target", "own", "n", "mse")


# M14 tree members: coverage of the 80 % interval by thirds of the predicted spread (checked by tests) -------------------
@register("ensemble_trees")
def ensemble_trees(spark, sf):
    from tempolith.operators import ensemble as EN
    o, before = _orders_xy(spark, sf)
    model = EN.fit(o.filter(before), "o_orderkey", ["x"], ["price"], linear=2, trees=2, depth=3)
    late = o.filter(~before)
    s = U.intervals(U.summarize_draws(EN.draws(late, "o_orderkey", model), ["o_orderkey", "target"]), "target", clamp_zero=False)
    s = cut_lineage(s.join(late.select("o_orderkey", "price"), "o_orderkey"))      # read for the cuts and again for the thirds
    cuts = s.groupBy("target").agg(F.percentile_approx("std_predictive", [1 / 3, 2 / 3], 10000).alias("cuts"))
    third = F.lit(1) + (F.col("std_predictive") > F.col("cuts")[0]).cast("int") + (F.col("std_predictive") > F.col("cuts")[1]).cast("int")
    return s.join(cuts, "target").withColumn("third", third).groupBy("target", "third").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("price").between(F.col("std80_lower"), F.col("std80_upper")).cast("double")).alias("std80_coverage"),
        F.avg("std_predictive").alias("std_predictive"))


# M6-M8 together with 5,000 categories: PCA part, indicators and a sparse vector, saved, loaded and applied -------------------
@register("preprocess_sparse", """
WITH o AS (SELECT o_orderkey, 'c' || (o_orderkey % 5000) AS cat, o_orderpriority, o_orderdate < TIMESTAMP '1999-01-01' AS fit FROM orders),
t AS (SELECT count(*) AS n FROM o WHERE fit),
k AS (SELECT cat, count(*) / any_value(t.n) AS p FROM o, t WHERE fit GROUP BY cat),
s AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS INTEGER) AS pos FROM k WHERE p * (1 - p) > 0.0001),
w AS (SELECT CAST(count(*) AS INTEGER) AS width FROM s),
i AS (SELECT CAST(count(*) AS INTEGER) AS shown FROM (SELECT o_orderpriority, count(*) / any_value(t.n) AS p FROM o, t WHERE fit GROUP BY 1) WHERE p * (1 - p) > 0.0001)
SELECT o_orderkey, width + shown + 1 AS size, pos + shown + 1 AS hot, CASE WHEN pos IS NULL THEN 0 ELSE 1 END AS n_hot FROM o LEFT JOIN s USING (cat), w, i
""")
def preprocess_sparse(spark, sf):
    from tempolith.operators.preprocess import Preprocessor
    from tempolith.session import scratch_path
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.concat(F.lit("c"), (F.col("o_orderkey") % 5000).cast("string")).alias("cat"),
                                          "o_orderdate")
    train = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    path = scratch_path(spark, "sparse_preprocess")
    Preprocessor.fit(train, numeric=["o_totalprice"], categorical=["o_orderpriority", "cat"], max_categories=100).save(spark, path)
    pre = Preprocessor.load(spark, path)
    out = pre.assembled(o)
    dense = len(pre.features)
    beyond = F.filter("features.indices", lambda i: i >= dense)
    return out.select("o_orderkey", F.col("features.size").alias("size"), F.try_element_at(beyond, F.lit(1)).alias("hot"), F.size(beyond).alias("n_hot"))
