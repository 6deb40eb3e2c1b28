"""Composed jobs (P1-P9): user-level pipelines built from the operators.

Each job is a lazy ``DataFrame -> DataFrame`` function.  Window stages are
ordered so that everything partitioned by the entity runs on one exchange,
(entity, season/context) windows reuse it (a sub-key of the same hash
partitioning), and per-date ranks - the only stage needing a different key -
come last.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolith.functions import dates as DT
from tempolith.functions import numeric as NU
from tempolith.functions import text as TX
from tempolith.operators import aggs as D
from tempolith.operators import ensemble as EN
from tempolith.operators import ewm as E
from tempolith.operators import filters as B
from tempolith.operators import intervals as IV
from tempolith.operators import joins as C
from tempolith.operators import sorting as S
from tempolith.operators import prep as P
from tempolith.operators import preprocess as PP
from tempolith.operators import uncertainty as U
from tempolith.operators import windows as W
from tempolith.session import checkpoint_dir, cut_lineage, keep_rows
from tempolith.sources import io as IO
from tempolith.sources import store as ST


# P1 ------------------------------------------------------------------------------------
AVAIL_COLS = ["team", "date", "person", "key", "status", "reason", "source"]


def prep_listing(df: DataFrame, source: str, date_formats=DT.DATE_FORMATS) -> DataFrame:
    """Tabular availability listing (PLAYER "Last, First", TEAM, DATE, optional STATUS/REASON)."""
    df = B.align_to(df, ["PLAYER", "TEAM", "DATE", "STATUS", "REASON"])
    out = df.select(
        F.trim("TEAM").alias("team"), DT.parse_date("DATE", date_formats).alias("date"),
        TX.strip_ws("PLAYER").alias("person"), TX.entity_key("PLAYER").alias("key"),
        F.trim("STATUS").alias("status"), F.trim("REASON").alias("reason"), F.lit(source).alias("source"))
    return B.complete_rows(out, ["team", "date", "key"])


def listing_rejects(df: DataFrame, date_formats=DT.DATE_FORMATS) -> DataFrame:
    """Rows of a listing that ``prep_listing`` leaves out, counted by reason and the text that was not understood."""
    df = B.align_to(df, ["PLAYER", "TEAM", "DATE"])
    reason = (F.when(F.trim("DATE").isNull() | (F.trim("DATE") == ""), F.lit("no date"))
              .when(DT.parse_date("DATE", date_formats).isNull(), F.lit("date not understood"))
              .when(F.col("TEAM").isNull(), F.lit("no team")).when(F.col("PLAYER").isNull(), F.lit("no person")))
    bad = df.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return bad.groupBy("reason", F.when(F.col("reason") == "date not understood", F.trim("DATE")).alias("text")).agg(F.count(F.lit(1)).alias("n"))


def prep_report(df: DataFrame, source: str) -> DataFrame:
    """Free-text availability report (player, team, updated, description)."""
    status, reason = TX.status_reason("description")
    out = df.select(F.trim("team").alias("team"), DT.parse_date("updated").alias("date"),
                    TX.strip_ws("player").alias("person"), TX.entity_key("player").alias("key"),
                    status.alias("status"), reason.alias("reason"), F.lit(source).alias("source"))
    return B.complete_rows(out, ["team", "date", "key"])


def consolidate_availability(parts: Sequence[DataFrame], status_prefix: str = "out",
                             priority: Sequence[str] | None = None) -> DataFrame:
    """Union the normalised sources, keep statuses starting with ``status_prefix``
    and one row per (team, date, key) - the first source in ``priority``."""
    u = C.union_aligned([p.select(*AVAIL_COLS) for p in parts])
    u = B.starts_with(u, "status", status_prefix)
    rank = F.array_position(F.array(*[F.lit(s) for s in priority]), F.col("source")) if priority else F.lit(0)
    return D.first_per(u, ["team", "date", "key"], [rank, F.col("source"), F.col("reason").asc_nulls_last()])


# P2 ------------------------------------------------------------------------------------
def key_member_flag(rows: DataFrame, member: str, group: str, date: str, flag: str,
                    unavailable: DataFrame, threshold: float = 0.5, out: str = "key_member_out") -> DataFrame:
    """Flag (group, date) rows when a key member (flag rate above threshold) is unavailable."""
    key_members = D.rate_above(rows, member, flag, threshold, out="_rate").select(member)
    out_keys = C.keep_known(unavailable, key_members, member)
    return C.flag_if_present(rows, out_keys.select(group, date), [group, date], out)


# P4 ------------------------------------------------------------------------------------
def feature_build(df: DataFrame, entity: str, order: Sequence[str], date: str, metrics: Sequence[str],
                  season: str | None = None, context: str | None = None,
                  context_values: Sequence[str] = (), span: float = 21, roll: int = 5,
                  slope_min_rows: int = 21, hot_metric: str | None = None,
                  interaction_pairs: Sequence[tuple[str, str]] = (), rank_cols: Sequence[str] | None = None,
                  active_days: int = 7, skew_safe: bool = False, partitions: int | None = None,
                  opponent: str | None = None, opponent_stats: Sequence[str] = (), team: str | None = None,
                  primary_metric: str | None = None, skew_safe_ranks: bool = True,
                  layout: str = "wide", rank_bits: int | None = None) -> DataFrame:
    """Leakage-safe feature block for every metric (W1-W17, W25) with per-date ranks.

    ``skew_safe=True`` runs the same features on range segments (see
    ``feature_build_skew_safe``) for data where one entity or one date can hold
    a large share of the rows.  With ``opponent``, the opponent-side "allowed"
    EWMs of ``opponent_stats`` (W19: daily sums per opponent and season,
    previous-day EWM, per-date rank) are joined back on (opponent, season,
    date) - a table of opponents x dates, small - and multiplied with the
    entity's EWM of the same stat when present (W25).  With ``team`` and
    ``primary_metric``, ``{metric}_primary`` flags the row(s) holding the
    team-date maximum of that metric's EWM mean (D13).  The per-date ranks run
    on range segments, all columns in one shuffle; ``skew_safe_ranks=False``
    gives them one window per date instead, for dates that are small.  ``layout="long"`` returns the per-metric
    features one row per (row, metric) from a single segmented pass over all
    metrics (``feature_build_long``; pivot with ``to_wide``)."""
    asked = {"context": context, "hot_metric": hot_metric, "interaction_pairs": interaction_pairs, "rank_cols": rank_cols,
             "opponent": opponent, "team": team, "primary_metric": primary_metric}
    if layout == "long" and any(asked.values()):
        raise ValueError(f"layout='long' has per-metric features only, not {sorted(k for k, v in asked.items() if v)}")
    if layout == "long":
        return feature_build_long(df, entity, order, date, metrics, season=season, span=span, roll=roll,
                                  slope_min_rows=slope_min_rows, partitions=partitions, rank_bits=rank_bits)
    if layout != "wide":
        raise ValueError(f"layout must be 'wide' or 'long', not {layout!r}")
    if skew_safe:
        return feature_build_skew_safe(df, entity, order, date, metrics, season=season, context=context,
                                       context_values=context_values, span=span, roll=roll,
                                       slope_min_rows=slope_min_rows, hot_metric=hot_metric,
                                       interaction_pairs=interaction_pairs, rank_cols=rank_cols,
                                       active_days=active_days, partitions=partitions, opponent=opponent,
                                       opponent_stats=opponent_stats, team=team, primary_metric=primary_metric,
                                       rank_bits=rank_bits)
    order, context_ranks = list(order), []
    df = W.lags(df, metrics, entity, order)
    df = W.expanding(df, metrics, entity, order)
    df = W.rolling(df, metrics, entity, order, n=roll)
    df = E.ewm(df, metrics, entity, order, span=span)
    df = W.delta(df, metrics)
    df = W.count_last_days(df, entity, date, days=active_days, out=f"n_last_{active_days}d")
    if context and context_values:
        df = E.ewm_by_context(df, metrics, entity, order, context, context_values, span=span)
        context_ranks = [f"{m}_ewm_mean_{v}" for m in metrics for v in context_values]
    grp = [entity, season] if season else [entity]
    df = W.trend_slope(df, metrics, grp, order, min_rows=slope_min_rows)
    df = W.rest_days(df, grp, date, order, out="rest_days", b2b="back_to_back")
    if hot_metric:
        df = W.hot_cold_flags(df, hot_metric, f"{hot_metric}_ewm_mean", f"{hot_metric}_ewm_std", "_hot", "_cold")
        df = W.streak_before(df, "_hot", grp, order, "hot_streak")
        df = W.streak_before(df, "_cold", grp, order, "cold_streak").drop("_hot", "_cold")
    df = _opponent_block(df, season, date, span, interaction_pairs, opponent, opponent_stats, team, primary_metric)
    # a context's column is NULL on other contexts' rows, so its rank by date is the rank within the context
    ranks = rank_cols if rank_cols is not None else [f"{m}_{s}" for m in metrics for s in ("exp_mean", "roll_mean", "ewm_mean", "slope")] + context_ranks
    if skew_safe_ranks:
        from tempolith.operators import segmented as SG
        return _ranked(df, ranks, rank_bits, lambda d, cols: SG.pct_rank_within(d, date, cols, partitions=partitions, together=True))
    return _ranked(df, ranks, rank_bits, lambda d, cols: W.pct_rank_within(d, date, cols))


def _ranked(df: DataFrame, cols: Sequence[str], bits: int | None, rank) -> DataFrame:
    """The frame without non-finite values and the ranks of the columns; with ``bits``, of their values rounded to
    multiples of 2**-bits, so that values which differ by rounding noise tie.  Those are finite, so the other columns
    are cleaned before the ranks are joined: one projection for all would be too long a method for the JVM to compile."""
    if bits is None:
        return NU.clean_non_finite(rank(df, list(cols)))
    scale = F.lit(float(2 ** bits))
    held = {f"_k_{c}": F.floor(F.col(c) * scale + F.lit(0.5)) / scale for c in cols}
    df = NU.clean_non_finite(df.withColumns(held), skip=held)
    return rank(df, list(held)).withColumnsRenamed({f"_k_{c}_prank": f"{c}_prank" for c in cols}).drop(*held)


def _opponent_block(df: DataFrame, season: str | None, date: str, span: float, interaction_pairs, opponent: str | None,
                    opponent_stats: Sequence[str], team: str | None, primary_metric: str | None) -> DataFrame:
    """Opponent-side EWMs, primary flags and interactions."""
    pairs = list(interaction_pairs)
    if opponent and opponent_stats:
        keys = [opponent] + ([season] if season else []) + [date]
        daily = E.allowed(df.select(*keys, *opponent_stats), keys[:-1], date, opponent_stats, span=span)
        df = df.join(daily, keys, "left")
        pairs += [(f"{st}_ewm_mean", f"allowed_{st}_ewm") for st in opponent_stats]
        pairs += [(f"{st}_ewm_mean", f"allowed_{st}_ewm_prank") for st in opponent_stats]
    if team and primary_metric:
        df = D.is_group_max(df, [team, date], f"{primary_metric}_ewm_mean", f"{primary_metric}_primary")
    return W.interactions(df, pairs)


# P5 ------------------------------------------------------------------------------------
def change_summary(changes: DataFrame, group) -> DataFrame:
    """Per group the number of log rows and two order-free sums of their hashes (``store.digest``): kept beside an
    interval table, it tells which groups' logs changed since. Sums, unlike xor, do not cancel for repeated rows."""
    return ST.digest(changes, group)


def intervals_incremental(existing: DataFrame | None, summary: DataFrame | None, changes: DataFrame, starters: DataFrame,
                          spans: DataFrame, group, member: str, clock: str, is_in: str, size: int, **kw) -> DataFrame:
    """Build intervals for the groups whose log is new or differs from the
    ``summary`` (see ``change_summary``) that belongs to ``existing``, and put
    them in the place of those groups' rows; other groups are kept as they are."""
    g = [group] if isinstance(group, str) else list(group)
    if existing is None:
        return IV.active_intervals(changes, starters, spans, g, member, clock, is_in, size=size, **kw)
    same = unchanged_groups(summary, changes, g)
    fresh = IV.active_intervals(*(IO.only_new(x, same, g) for x in (changes, starters, spans)),
                                g, member, clock, is_in, size=size, **kw)
    return existing.join(same, g, "left_semi").unionByName(fresh.select(*existing.columns))


def unchanged_groups(summary: DataFrame, changes: DataFrame, group) -> DataFrame:
    """Groups whose log is still the one that ``summary`` describes."""
    g = [group] if isinstance(group, str) else list(group)
    now = change_summary(changes, g)
    return cut_lineage(ST.of_groups(now, summary, now.columns).select(*g))


def on_off_incremental(existing: DataFrame, same: DataFrame, intervals: DataFrame, group, counters: Sequence[str]) -> DataFrame:
    """On/off totals (D5-D7): the rows of the groups in ``same`` are kept, those
    of all others are computed from their intervals and take the old rows' place."""
    g = [group] if isinstance(group, str) else list(group)
    fresh = IV.on_off(IO.only_new(intervals, same, g), g, counters)
    return existing.join(same, g, "left_semi").unionByName(fresh.select(*existing.columns))


def update_interval_store(store: ST.GroupStore, changes: DataFrame, starters: DataFrame, spans: DataFrame, events: DataFrame,
                          member: str, clock: str, is_in: str, size: int, counters: dict, bucket_width: float,
                          group=None, event=None, **kw) -> DataFrame:
    """P5 and D7 as one daily run: tables ``intervals`` (with their events' ``counters``, aggregates by name) and
    ``on_off`` of a store, rebuilt for the groups of which any input changed - log, starters, spans or counted events.

    ``group`` is what has intervals of its own (by default the store's group). With ``event``, boundaries are shared
    inside it, as by the teams of a match; then the store must be kept by event, as a change of one team's log moves the
    other's intervals. Returns the groups that were rebuilt."""
    g = store.group if group is None else [group] if isinstance(group, str) else list(group)

    def build(part: dict[str, DataFrame]) -> dict[str, DataFrame]:
        bnd = cut_lineage(IV.boundaries(part["changes"], part["spans"], g, clock, event=event))
        iv = cut_lineage(IV.active_intervals(part["changes"], part["starters"], part["spans"], g, member, clock, is_in, size=size, bnd=bnd, **kw))
        placed = IV.assign_intervals(part["events"], bnd, g, clock, bucket_width=bucket_width).filter(F.col("k").isNotNull())
        counted = iv.join(placed.groupBy(*g, "k").agg(*[e.alias(n) for n, e in counters.items()]), [*g, "k"], "left")
        counted = cut_lineage(counted.fillna(0, subset=list(counters)))
        return {"intervals": counted, "on_off": IV.on_off(counted, g, list(counters))}

    return store.update({"changes": changes, "starters": starters, "spans": spans, "events": events}, build)


# P3 ------------------------------------------------------------------------------------
def ready_rows(events: DataFrame, parts: DataFrame, key: str, part_key: str, entity: str, season: str, stat: str,
               top_order: Sequence, top_cols: Sequence[str], total: str, weight: tuple[str, str], drop: Sequence[str],
               absent: str, least_rows: int, least_mean: float, last_season: int,
               unavailable: DataFrame, group: str, date: str, starter: str) -> DataFrame:
    """Feature-ready rows: events with the totals (D3), weighted mean (D4) and
    top row (C7) of their parts, the key-member flag (P2), then the filters
    B1, B5, B7, B8, B9 and B10.

    ``parts`` holds the detail rows of each event; ``absent`` is the flag of
    rows that did not take part."""
    sums = parts.groupBy(part_key).agg(F.sum(total).alias(total), F.count(F.lit(1)).alias("n_parts"))
    mean = D.weighted_mean(parts, [part_key], weight[0], weight[1], out=f"{weight[0]}_wmean")
    sums = sums.join(mean, part_key, "left")
    top = parts.select(F.col(part_key).alias(key), *top_cols)
    rows = C.enrich_first(C.enrich_on(events, sums, [(key, part_key)]), top, key, top_order)
    rows = key_member_flag(rows, entity, group, date, starter, unavailable)
    rows = B.complete_rows(B.drop(rows, part_key, *drop), [total])
    rows = B.participated(rows, absent, stat)
    rows = B.min_rows(rows, entity, least_rows)
    rows = B.qualify(rows, [entity, season], stat, least_mean)
    return B.active_in(rows, entity, season, last_season)


# P6 ------------------------------------------------------------------------------------
def upcoming_slate(schedule: DataFrame, home: str, away: str, roster: DataFrame, history_roster: DataFrame,
                   team: str, max_roster: int, roster_order: Sequence, latest: DataFrame,
                   person: str) -> DataFrame:
    """Schedule -> one row per side -> roster -> latest feature row per person.

    A team's current roster is taken whole; a team without one gets its last
    known members, the first ``max_roster`` in ``roster_order`` (most recent
    appearance first).  One row per team and person."""
    sides = C.double_sides(schedule, home, away, team=team)
    have = roster.select(team).distinct()
    fallback = S.top_n_per_group(C.only_unknown(history_roster, have, team), team, roster_order, max_roster)
    full = C.union_aligned([roster, fallback.select(*[c for c in roster.columns if c in fallback.columns])])
    full = full.dropDuplicates([team, person])
    rows = C.expand_roster(sides, full, team)
    rows = rows.filter(F.col(person).isNotNull())
    return rows.join(latest, person, "left")


def refresh_for_slate(history: DataFrame, slate: DataFrame, build, marker: str = "_slate") -> DataFrame:
    """Features for upcoming rows computed with those rows appended to the
    history (so lags and running stats include each entity's latest event),
    instead of copying the last historical feature row.  ``build`` is the
    feature function (e.g. ``lambda d: feature_build(d, ...)``); only the slate
    rows are returned.  Leakage-safe by construction: every feature of a row
    only reads earlier rows, and slate rows carry no target values."""
    rows = history.withColumn(marker, F.lit(False)).unionByName(
        slate.withColumn(marker, F.lit(True)), allowMissingColumns=True)
    return build(rows).filter(F.col(marker)).drop(marker)


# P7 ------------------------------------------------------------------------------------
def score_and_publish(summary: DataFrame, q_scale: DataFrame, y_params: DataFrame, eligible: DataFrame,
                      key: str, date: str, today, path: str, run_date) -> DataFrame:
    """Calibrate + clamp intervals, keep eligible keys, pick the next slate and
    write a run-dated partition; returns the published rows read back."""
    iv = U.intervals(summary, "target", q_scale=q_scale, y_params=y_params, center="median")
    iv = C.keep_known(iv, eligible, key)
    iv = B.next_slate(iv, date, today)
    IO.save_dated(iv, path, run_date)
    spark = summary.sparkSession
    return spark.read.parquet(path).filter(F.col("run_date") == F.lit(run_date).cast("date"))


def fit_artifacts(train: DataFrame, row: str, targets: Sequence[str], path: str, members: int = 10, calibrate: float = 0.5,
                  **columns) -> None:
    """Fit and save everything that scoring needs under ``path``.

    Preprocessing (``columns`` go to ``Preprocessor.fit``), target moments, the
    ensemble, fitted on the rows outside a hashed share, and from that share the
    std and quantile scales."""
    spark = train.sparkSession
    pre = PP.Preprocessor.fit(train, **columns)
    pre.save(spark, f"{path}/preprocess")
    moments = P.fit_scaler(train, targets)
    moments.write.mode("overwrite").parquet(f"{path}/targets")
    moments = spark.read.parquet(f"{path}/targets")
    rows = P.hash_split(P.scale(pre.transform(train), moments, targets), row, calibrate)
    rows = cut_lineage(rows.select(row, "is_cal", *targets, *pre.features))
    fitted = U.fit_ensemble(rows.filter("NOT is_cal"), row, pre.features, targets, members=members)
    PP.save_ensemble(spark, fitted, f"{path}/ensemble")
    summary = U.summarize_draws(U.score_draws(rows.filter("is_cal"), row, pre.features, fitted), [row, "target"])
    y = rows.filter("is_cal").unpivot([row], list(targets), "target", "y")
    cal = cut_lineage(summary.join(y, [row, "target"]))
    U.fit_std_scale(cal, "target", "y", "mean_pred", "std_epistemic", "std_aleatoric").write.mode("overwrite").parquet(f"{path}/std_scale")
    U.fit_quantile_scale(cal, "target", "y", "q50", "q10", "q90").write.mode("overwrite").parquet(f"{path}/quantile_scale")


def score_slate(slate: DataFrame, row: str, path: str, targets: Sequence[str], measures: Sequence[str],
                calibrated: bool = True, clamp_zero: bool = True) -> DataFrame:
    """Score rows with the artifacts under ``path`` and lay them out wide: one
    row per id, ``{target}_{measure}`` for every target and measure.

    Draws use the std scale for their noise; quantile bounds are spread by the
    quantile scale; all go back to the targets' units."""
    spark = slate.sparkSession
    pre = PP.Preprocessor.load(spark, f"{path}/preprocess")
    fitted = PP.load_ensemble(spark, f"{path}/ensemble")
    std = spark.read.parquet(f"{path}/std_scale") if calibrated else None
    quantile = spark.read.parquet(f"{path}/quantile_scale") if calibrated else None
    moments = spark.read.parquet(f"{path}/targets")
    per_target = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"{t}__mean").alias("y_mean"), F.col(f"{t}__scale").alias("y_scale")) for t in targets]))
    draws = U.score_draws(pre.transform(slate), row, pre.features, fitted)
    summary = U.summarize_draws(draws, [row, "target"], scale=std)
    out = U.intervals(summary, "target", q_scale=quantile, y_params=moments.select(per_target.alias("t")).select("t.*"), clamp_zero=clamp_zero)
    return U.display_table(out, [row], "target", targets, measures)


def fit_scoring(train: DataFrame, row: str, targets: Sequence[str], path: str, members: int = 10, trees: int = 0, calibrate: float = 0.5,
                priors: dict[str, str] | None = None, **columns) -> None:
    """``fit_artifacts`` with the whole uncertainty regression: members with a row-dependent log-variance
    (``ensemble.fit``, ``members`` linear ones and ``trees``), on a hashed share of held-out rows the blend with
    ``priors`` (a prior mean column per target, in the target's units) and then the std and quantile scales of the
    blended draws. Preprocessing and moments take many passes, so the columns of ``train`` that are used are computed
    once and kept."""
    spark = train.sparkSession
    train = _used(train, row, targets, priors, columns)
    pre = PP.Preprocessor.fit(train, **columns)
    pre.save(spark, f"{path}/preprocess")
    P.fit_scaler(train, targets).write.mode("overwrite").parquet(f"{path}/targets")
    moments = spark.read.parquet(f"{path}/targets")
    rows, scaled = _scaled_priors(pre.transform(train), moments, priors)
    rows = P.hash_split(P.scale(rows, moments, targets), row, calibrate)
    rows = cut_lineage(rows.select(row, "is_cal", *targets, *pre.features, *scaled.values()))
    held = rows.filter("is_cal")
    model = EN.fit(rows.filter("NOT is_cal"), row, pre.features, targets, linear=members, trees=trees, kept=True)
    if scaled:
        model = EN.with_blend(model, held, row, scaled)
    EN.save(model, spark, f"{path}/ensemble")
    summary = U.summarize_draws(EN.draws(held, row, model, priors=scaled or None), [row, "target"])
    cal = cut_lineage(summary.join(held.unpivot([row], list(targets), "target", "y"), [row, "target"]))
    U.fit_std_scale(cal, "target", "y", "mean_pred", "std_epistemic", "std_aleatoric").write.mode("overwrite").parquet(f"{path}/std_scale")
    U.fit_quantile_scale(cal, "target", "y", "q50", "q10", "q90").write.mode("overwrite").parquet(f"{path}/quantile_scale")


def _used(df: DataFrame, row: str, targets: Sequence[str], priors: dict[str, str] | None, columns: dict, *others: str) -> DataFrame:
    """The columns that fitting and scoring use, computed once (checkpointed)."""
    lists = [columns.get(k, ()) for k in ("numeric", "categorical", "index", "priors")]
    return keep_rows(df.select(*dict.fromkeys([row, *others, *targets, *(priors or {}).values(), *[c for names in lists for c in names]])), row)


def _scaled_priors(df: DataFrame, moments: DataFrame, priors: dict[str, str] | None) -> tuple[DataFrame, dict[str, str]]:
    """Prior means in the targets' standard units, as columns of their own."""
    if not priors:
        return df, {}
    p = P.one_row(moments)
    return df.withColumns({f"_prior_{t}": (F.col(c) - p[f"{t}__mean"]) / p[f"{t}__scale"] for t, c in priors.items()}), {t: f"_prior_{t}" for t in priors}


#: What is published for every target.
MEASURES = ("mean_pred", "q10", "q50", "q90", "std80_lower", "std80_upper", "pi80_width", "std_predictive", "std_epistemic", "std_aleatoric")


def publish_slate(slate: DataFrame, row: str, path: str, targets: Sequence[str], eligible: DataFrame, key: str, date: str, today, out: str, run_date,
                  priors: dict[str, str] | None = None, dampen: dict | None = None, measures: Sequence[str] = MEASURES, clamp_zero: bool = True) -> DataFrame:
    """P7 as one job on the artifacts of ``fit_scoring``: eligible keys, the next slate, priors dampened (arguments of
    ``prep.dampen``) and blended, draws, scales, bounds in the targets' units, one wide row per id, a run-dated partition.

    Rows that are not published are left out before anything is scored. Returns the published rows read back."""
    spark = slate.sparkSession
    rows = B.next_slate(C.keep_known(slate, eligible, key), date, today)
    if dampen is not None:
        rows = P.dampen(rows, targets, **dampen)
    pre, model = PP.Preprocessor.load(spark, f"{path}/preprocess"), EN.load(spark, f"{path}/ensemble")
    moments = spark.read.parquet(f"{path}/targets")
    rows, scaled = _scaled_priors(rows, moments, priors)
    ids = rows.select(row, key, date)
    draws = EN.draws(pre.transform(rows), row, model, priors=scaled or None)
    summary = U.summarize_draws(draws, [row, "target"], scale=spark.read.parquet(f"{path}/std_scale"))
    per_target = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"{t}__mean").alias("y_mean"), F.col(f"{t}__scale").alias("y_scale")) for t in targets]))
    iv = U.intervals(summary, "target", q_scale=spark.read.parquet(f"{path}/quantile_scale"), y_params=moments.select(per_target.alias("t")).select("t.*"), clamp_zero=clamp_zero)
    wide = ids.join(U.display_table(iv, [row], "target", targets, measures), row)
    IO.save_dated(wide, out, run_date)
    return spark.read.parquet(out).filter(F.col("run_date") == F.lit(run_date).cast("date"))


# P8 ------------------------------------------------------------------------------------
def train_evaluate(df: DataFrame, row: str, split: str, boundary, targets: Sequence[str], path: str, members: int = 10, trees: int = 0,
                   priors: dict[str, str] | None = None, calibrate: float = 0.5, **columns) -> DataFrame:
    """Fit on the rows before ``boundary`` of ``split`` (M1), evaluate on those from it on.

    Fitting is ``fit_scoring``: preprocessing (medians, moments, PCA, indicators, indexes, sparse vectors: ``columns``),
    members, blend and scales, all saved under ``path``. The result has a row per target and suffix, "cal" with the
    fitted scales and "uncal" without (M19), in the targets' units; rows without a target are not evaluated."""
    spark = df.sparkSession
    train, valid = P.temporal_split(_used(df, row, targets, priors, columns, split), split, boundary, valid_on_or_after=True)
    fit_scoring(train, row, targets, path, members=members, trees=trees, calibrate=calibrate, priors=priors, **columns)
    pre, model = PP.Preprocessor.load(spark, f"{path}/preprocess"), EN.load(spark, f"{path}/ensemble")
    moments = spark.read.parquet(f"{path}/targets")
    rows, scaled = _scaled_priors(valid, moments, priors)
    draws = cut_lineage(EN.draws(pre.transform(rows), row, model, priors=scaled or None))
    y = valid.unpivot([row], list(targets), "target", "y").filter("y IS NOT NULL")
    per_target = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"{t}__mean").alias("y_mean"), F.col(f"{t}__scale").alias("y_scale")) for t in targets]))
    units = moments.select(per_target.alias("t")).select("t.*")
    out = []
    for suffix, std, quantile in (("cal", spark.read.parquet(f"{path}/std_scale"), spark.read.parquet(f"{path}/quantile_scale")), ("uncal", None, None)):
        iv = U.intervals(U.summarize_draws(draws, [row, "target"], scale=std), "target", q_scale=quantile, y_params=units, clamp_zero=False)
        out.append(U.evaluate(iv.join(y, [row, "target"]), "target", "y", suffix))
    return out[0].unionByName(out[1])


# P9 ------------------------------------------------------------------------------------
def browse(df: DataFrame, order: Sequence, tie: str, query: str | None, groups: dict, pick: Sequence[str],
           page_no: int, size: int) -> DataFrame:
    """Round numerics to 1 decimal, search, keep the picked column groups, sort, page."""
    r = NU.round_numeric(df, 1)
    r = B.search_all(r, query)
    cols = B.group_columns(r.columns, groups)
    keep = [c for g in pick for c in cols.get(g, [])]
    r = r.select(*dict.fromkeys(keep + [tie]))
    return S.page(r, list(order), page_no, size, tie=tie)


def _ewm_block(seg, key, m: str, alpha: float, rising: Sequence[str] = ()):
    """The EWM features of the rows before (W7-W11) on segments."""
    from tempolith.operators import segmented as SG
    mean, std, prev = f"{m}_ewm_mean", f"{m}_ewm_std", f"{m}_lag1"
    seg = SG.ewm_on_segments(seg, key, prev, f"_{m}_x0", alpha, mean, std)
    diff = F.col(prev) - F.col(mean)
    seg = seg.then(lambda d: d.withColumns({
        f"{m}_ewm_z": diff / (F.col(std) + F.lit(E.EPS)),
        f"{m}_ewm_above": F.coalesce(F.col(prev) > F.col(mean), F.lit(False)).cast("int"),
        f"{m}_ewm_revert": F.abs(diff) / (F.col(std) + F.lit(E.EPS)),
        f"{m}_ewm_dev": F.abs(diff)}))
    seg = SG.sum_on_segments(seg, key, f"{m}_ewm_above", f"{m}_ewm_surges", rising=rising)
    return seg.then(lambda d: d.withColumn(f"{m}_ewm_surges", F.col(f"{m}_ewm_surges").cast("long")))


def feature_build_skew_safe(df: DataFrame, entity: str, order: Sequence[str], date: str, metrics: Sequence[str],
                            season: str, context: str | None = None, context_values: Sequence[str] = (),
                            span: float = 21, roll: int = 5, slope_min_rows: int = 21,
                            hot_metric: str | None = None, interaction_pairs: Sequence[tuple[str, str]] = (),
                            rank_cols: Sequence[str] | None = None, active_days: int = 7,
                            partitions: int | None = None, opponent: str | None = None,
                            opponent_stats: Sequence[str] = (), team: str | None = None,
                            primary_metric: str | None = None, rank_bits: int | None = None) -> DataFrame:
    """``feature_build`` for data where one entity or one date can hold a large
    share of all rows: every per-entity stage runs on range segments of the
    entity's series and per-date ranks on range segments of the date (see
    ``operators.segmented``); outputs are identical.  ``season`` must not
    decrease along ``order`` (e.g. a year of the date)."""
    from tempolith.operators import segmented as SG
    order = list(order)
    alpha = E.alpha_from_span(span)
    df, entity = SG.without_nulls(df, [entity])      # keys are joined on: a NULL entity is one like others
    def by_context(m: str) -> DataFrame:
        ctx = SG.running_features(df.filter(F.col(context).isin(list(context_values))).select(*entity, context, *order, m), [*entity, context], order, [m],
                                  lags=(1,), roll=0, partitions=partitions)
        ctx_rows = SG.ewm_on_segments(ctx, [*entity, context], f"{m}_lag1", f"_{m}_x0", alpha, "_cm", "_cs").rows
        outs = {f"{m}_ewm_mean_{v}": F.when(F.col(context) == v, F.col("_cm")) for v in context_values}
        return ctx_rows.select(*entity, *order, *[e.alias(k) for k, e in outs.items()])

    checkpoint_dir(df.sparkSession)
    with ThreadPoolExecutor(1) as beside:            # the many small steps of the contexts run beside those of the whole series
        contexts = [beside.submit(inheritable_thread_target(df.sparkSession)(by_context), m) for m in metrics if context and context_values]
        seg = SG.running_features(df, entity, [season] + order, metrics, lags=(1, 2), roll=roll, partitions=partitions, join=lambda d: SG.count_last_days(
            d, entity, date, days=active_days, out=f"n_last_{active_days}d"))
        many = len(metrics) > 1
        for m in metrics:
            seg = _ewm_block(seg, entity, m, alpha, rising=[season]).stage(whole=many)
        seg = seg.then(lambda d: W.delta(d, metrics))
        flags = {}
        if hot_metric:
            seg = seg.then(lambda d: W.hot_cold_flags(d, hot_metric, f"{hot_metric}_ewm_mean", f"{hot_metric}_ewm_std", "_hot", "_cold"))
            flags = {"_hot": "hot_streak", "_cold": "cold_streak"}
        for i, m in enumerate(metrics):
            seg = SG.season_features(seg, entity, season, date, f"{m}_lag1", flags if i == 0 else {},
                                     f"{m}_slope", slope_min_rows=slope_min_rows, rising=[season])
            seg = seg.stage(whole=True) if many else seg
        rows = seg.rows.drop("_hot", "_cold", *SG.HELPERS, *[f"_{m}_x0" for m in metrics])
        for c in contexts:
            rows = SG.left_join_nulls(rows, c.result(), entity + order)
    if opponent or team:
        rows = cut_lineage(rows)                     # read again for the opponents' and the teams' tables
    rows = _opponent_block(rows, season, date, span, interaction_pairs, opponent, opponent_stats, team, primary_metric)
    ranks = rank_cols if rank_cols is not None else [f"{m}_{s}" for m in metrics for s in ("exp_mean", "roll_mean", "ewm_mean", "slope")] + [
        f"{m}_ewm_mean_{v}" for m in metrics for v in (context_values if context else ())]
    return _ranked(rows.drop(*entity), ranks, rank_bits, lambda d, cols: SG.pct_rank_within(d, date, cols, partitions=partitions, together=True))


def feature_build_long(df: DataFrame, entity: str, order: Sequence[str], date: str, metrics: Sequence[str],
                       season: str | None = None, span: float = 21, roll: int = 5, slope_min_rows: int = 21,
                       keep: Sequence[str] = (), ranks: Sequence[str] = ("exp_mean", "roll_mean", "ewm_mean", "slope"),
                       metric_col: str = "metric", value_col: str = "x", partitions: int | None = None,
                       rank_bits: int | None = None) -> DataFrame:
    """Per-metric features in long layout: one row per (row, metric).

    The metrics are unpivoted once and every step runs a single time on range
    segments of (entity, metric, order), so neither a hot entity nor the number
    of metrics makes a large task, and the number of stages and checkpoints is
    that of one metric (a wide frame of 47 metrics x 25 features would be
    ~1,200 columns and ~1,000 window projections).  Ranks per (date, metric)
    run on range segments too, all features in one shuffle, and come back by a
    generated row id.  NULL entities and seasons are groups like others;
    ``season`` must not decrease along ``order``.  Column names are
    ``{value_col}_lag1``, ``{value_col}_exp_mean``, ...; ``to_wide`` pivots back."""
    from tempolith.operators import segmented as SG
    order, x = list(order), value_col
    ids = list(dict.fromkeys([entity, date] + order + ([season] if season and season not in order else []) + list(keep)))
    rows, keys = SG.without_nulls(df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]), [entity])
    part = keys + [metric_col]
    rows = rows.unpivot([*ids, *keys], list(metrics), metric_col, x)
    seg = SG.running_features(rows, part, order, [x], lags=(1, 2), roll=roll, partitions=partitions)
    seg = _ewm_block(seg, part, x, E.alpha_from_span(span)).then(lambda d: W.delta(d, [x]).withColumns({
        "_season": F.coalesce(F.col(season).cast("string"), F.lit("")) if season else F.lit(""), "_day": F.lit(None).cast("date")}))     # rest days are no feature of a metric
    rows = SG.season_features(seg, part, "_season", "_day", f"{x}_lag1", {}, f"{x}_slope", slope_min_rows=slope_min_rows).rows
    rows = rows.drop("_day", "rest_days", "back_to_back", *SG.HELPERS, "_season", f"_{x}_x0", *keys)
    return _ranked(rows, [f"{x}_{r}" for r in ranks], rank_bits,
                   lambda d, cols: SG.pct_rank_within(d, [date, metric_col], cols, partitions=partitions, together=True))


def to_wide(long: DataFrame, keys: Sequence[str], metrics: Sequence[str], features: Sequence[str],
            metric_col: str = "metric", value_col: str = "x") -> DataFrame:
    """Pivot a long feature frame back to ``{metric}_{feature}`` columns with an
    explicit metric list (no distinct-values pass); one shuffle on ``keys``."""
    aggs = [F.first(f).alias(f[len(value_col) + 1:] if f.startswith(value_col + "_") else f) for f in features]
    wide = long.groupBy(*keys).pivot(metric_col, list(metrics)).agg(*aggs)
    if len(aggs) == 1:
        only = features[0][len(value_col) + 1:] if features[0].startswith(value_col + "_") else features[0]
        wide = wide.withColumnsRenamed({m: f"{m}_{only}" for m in metrics})
    return wide
