"""Feature builds that go on from saved state.

A ``FeatureStore`` keeps the per-entity features of every row in long layout (one row per row and metric) and, per
entity and metric, what the next row needs: counts and central moments, extremes, the last values, the EWM's mean,
spread terms and gap, and the running count. A daily run reads an entity's new rows only and continues from there;
moments are merged as (n, mean, M2), the EWM as the affine map of its new rows, so a continued build equals one over
all rows. An entity whose earlier rows are not those that its state was made of - corrected, late, removed or repeated
ones, told by a multiset digest - is built anew from all its rows.

Features lie in folders by bucket of the entity and run; a run that rebuilds entities of a bucket writes the whole bucket
anew. The runs that count are named in a small table that is written last, so an update that breaks off leaves
nothing behind for readers, and repeating it writes the same files.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolith.operators import ewm as E
from tempolith.operators.windows import UNB, CUR
from tempolith.session import cut_lineage, drop_path
from tempolith.sources import store as ST

METRIC, VALUE = "metric", "x"
#: Columns of the state beside entity and metric.
STATE = ("n", "mean", "m2", "mx", "mn", "tail", "em", "ec", "eu", "gap", "surges")


def _merged(n1: Column, m1: Column, q1: Column, n2: Column, m2: Column, q2: Column) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared deviations of two parts together; stable, however far the means lie from 0."""
    n = n1 + n2
    away = m2 - m1
    share = F.try_divide(n2.cast("double"), n)
    mean = F.when(n1 == 0, m2).when(n2 == 0, m1).otherwise(m1 + away * share)
    return n, mean, F.when(n1 == 0, q2).when(n2 == 0, q1).otherwise(q1 + q2 + away * away * n1 * share)


def extend(rows: DataFrame, state: DataFrame | None, entity: str, order: Sequence[str], span: float = 21, roll: int = 5) -> tuple[DataFrame, DataFrame]:
    """Features of new rows, given the state that the rows before them left; and the state after them.

    ``rows``: (entity, *order, metric, x, others), all later in ``order`` than the rows behind ``state``. One
    exchange on (entity, metric); the state joins on the same key. The features are written nowhere yet."""
    order, keys = list(order), [entity, METRIC]
    alpha = E.alpha_from_span(span)
    if state is None:
        state = rows.select(*keys).limit(0).withColumns({"n": F.lit(0).cast("long"), **{c: F.lit(None).cast("double") for c in ("mean", "m2", "mx", "mn", "em", "ec", "eu")},
                                                         "tail": F.array().cast("array<double>"), "gap": F.lit(None).cast("long"), "surges": F.lit(0).cast("long")})
    held = state.select(*[F.col(k).alias(f"_h_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in STATE])
    match = F.col(entity).eqNullSafe(F.col(f"_h_{entity}")) & (F.col(METRIC) == F.col(f"_h_{METRIC}"))
    d = rows.join(held, match, "left").drop(f"_h_{entity}", f"_h_{METRIC}")
    d = d.withColumns({"_s_n": F.coalesce("_s_n", F.lit(0)), "_s_surges": F.coalesce("_s_surges", F.lit(0)), "_s_tail": F.coalesce("_s_tail", F.array().cast("array<double>"))})
    w = Window.partitionBy(*keys).orderBy(*order)
    now, x = w.rowsBetween(UNB, CUR), F.col(VALUE)
    d = d.withColumns({"_i": F.row_number().over(w), "_shift": F.coalesce("_s_em", F.first(VALUE, ignorenulls=True).over(now))})

    # values k rows back, the current one included for k = 0: of the new rows or of the stored tail
    back = {k: F.when(F.col("_i") > k, F.lag(VALUE, k).over(w) if k else x).otherwise(F.try_element_at(F.col("_s_tail"), F.col("_i") - k - 1)) for k in range(roll + 1)}
    d = d.withColumns({f"_b{k}": c for k, c in back.items()})

    # moments with the current row: the new rows' own about the shift, merged with the stored ones
    moved = x - F.col("_shift")
    d = d.withColumns({"_ln": F.count(VALUE).over(now), "_ls": F.sum(moved).over(now), "_lq": F.sum(moved * moved).over(now),
                       "_amx": F.greatest(F.max(VALUE).over(now), F.col("_s_mx")), "_amn": F.least(F.min(VALUE).over(now), F.col("_s_mn"))})
    local = F.try_divide(F.col("_ls"), F.col("_ln"))
    n, mean, m2 = _merged(F.col("_s_n"), F.col("_s_mean"), F.col("_s_m2"), F.col("_ln"), F.col("_shift") + local,
                          F.greatest(F.col("_lq") - F.col("_ls") * local, F.lit(0.0)))
    d = d.withColumns({"_an": n, "_amean": mean, "_am2": m2})

    # EWM with the current row: about the stored mean, so its own start is 0; the spread terms add what they were, decayed
    ln_d, a = repr(math.log1p(-alpha)), repr(alpha)
    part = ", ".join(E._q(k) for k in keys)
    over = f"OVER (PARTITION BY {part} ORDER BY {', '.join(E._q(c) for c in order)}"
    qx = E._q(VALUE)
    seen_at = f"last(CASE WHEN {qx} IS NOT NULL THEN `_i` END, true) {over} {E.BEFORE})"
    d = d.withColumn("_g", F.expr(f"CAST(`_i` - coalesce({seen_at}, -`_s_gap`) AS DOUBLE)"))
    later, first = f"({qx} IS NOT NULL AND `_g` IS NOT NULL)", f"({qx} IS NOT NULL AND `_g` IS NULL)"
    old = f"exp(`_g` * {ln_d})"
    log_a = f"(CASE WHEN {later} THEN `_g` * {ln_d} - ln({old} + {a}) ELSE 0D END)"
    b = f"(CASE WHEN {later} THEN {a} / ({old} + {a}) WHEN {first} THEN 1D ELSE 0D END)"
    aa = f"(CASE WHEN {later} THEN {old} / ({old} + {a}) ELSE 0D END)"
    xs = f"({qx} - `_shift`)"
    d = E.affine_scan(d, keys, order, log_a, [(f"{b} * {xs}", 1, "_m")], tag="fs")
    d = d.withColumn("_mp", F.expr(f"coalesce(lag(`_m`, 1) {over}), 0D)"))
    dev = f"({xs} - `_mp`)"
    d = E.affine_scan(d, keys, order, log_a, [(f"{aa} * {b} * {dev} * {dev}", 1, "_c"), (f"2D * {aa} * {b}", 2, "_u")], tag="fs")
    seen = F.col("_s_em").isNotNull() | (F.col("_ln") > 0)
    d = d.withColumns({"_aem": F.when(seen, F.col("_m") + F.col("_shift")),
                       "_aec": F.col("_c") + F.coalesce(F.exp("_fs_L") * F.col("_s_ec"), F.lit(0.0)),
                       "_aeu": F.col("_u") + F.coalesce(F.exp(2 * F.col("_fs_L")) * F.col("_s_eu"), F.lit(0.0)),
                       "_agap": F.col("_i") - F.coalesce(F.last(F.when(x.isNotNull(), F.col("_i")), ignorenulls=True).over(now), -F.col("_s_gap"))})

    # features read the state before their row: the row before, or the stored one
    stored = {"an": "n", "amean": "mean", "am2": "m2", "amx": "mx", "amn": "mn", "aem": "em", "aec": "ec", "aeu": "eu"}
    d = d.withColumns({f"_p{c}": F.when(F.col("_i") > 1, F.lag(f"_{c}", 1).over(w)).otherwise(F.col(f"_s_{s}")) for c, s in stored.items()})
    some, prev = F.col("_pan") > 0, F.col("_b1")
    std = F.when((F.col("_paem").isNotNull()) & (F.col("_paeu") > E.W2_TOL), F.sqrt(F.col("_paec") / F.col("_paeu")))
    diff = prev - F.col("_paem")
    window = [F.col(f"_b{k}") for k in range(roll, 0, -1)]               # oldest first
    full = F.lit(True)
    for v in window:
        full = full & v.isNotNull()
    centre = sum(window[1:], window[0]) / roll
    at = [k - (roll - 1) / 2.0 for k in range(roll)]
    f = {"lag1": prev, "lag2": F.col("_b2"), "exp_mean": F.when(some, F.col("_pamean")), "exp_std": F.when(F.col("_pan") > 1, F.sqrt(F.col("_pam2") / (F.col("_pan") - 1))),
         "exp_max": F.col("_pamx"), "exp_min": F.col("_pamn"),
         "roll_mean": F.when(full, centre), "roll_std": F.when(full, F.sqrt(sum((F.pow(v - centre, 2) for v in window), F.lit(0.0)) / (roll - 1))),
         "roll_max": F.when(full, F.greatest(*window)), "roll_min": F.when(full, F.least(*window)),
         "roll_mad": F.when(full, sum((F.abs(v - centre) for v in window), F.lit(0.0)) / float(roll)),
         "roll_trend": F.when(full, sum((v * t for v, t in zip(window, at)), F.lit(0.0)) / sum(t * t for t in at)),
         "ewm_mean": F.col("_paem"), "ewm_std": std, "ewm_z": diff / (std + E.EPS), "ewm_above": F.coalesce(prev > F.col("_paem"), F.lit(False)).cast("int"),
         "ewm_revert": F.abs(diff) / (std + E.EPS), "ewm_dev": F.abs(diff), "delta": prev - F.col("_pamean")}
    d = d.withColumns({f"{VALUE}_{k}": c for k, c in f.items()})
    d = d.withColumn(f"{VALUE}_ewm_surges", (F.sum(f"{VALUE}_ewm_above").over(now) + F.col("_s_surges")).cast("long"))
    d = cut_lineage(d)

    after = F.struct(F.col("_an").alias("n"), F.col("_amean").alias("mean"), F.col("_am2").alias("m2"), F.col("_amx").alias("mx"), F.col("_amn").alias("mn"),
                     F.array(*[F.col(f"_b{k}") for k in range(roll, -1, -1)]).alias("tail"), F.col("_aem").alias("em"), F.col("_aec").alias("ec"), F.col("_aeu").alias("eu"),
                     F.col("_agap").cast("long").alias("gap"), F.col(f"{VALUE}_ewm_surges").alias("surges"))
    fresh = d.groupBy(*keys).agg(F.max_by(after, "_i").alias("_a")).select(*keys, "_a.*")
    kept = ST.of_groups(state.select(*keys, *STATE), fresh, keys, "left_anti")
    return d.select(*rows.columns, *[f"{VALUE}_{k}" for k in f], f"{VALUE}_ewm_surges"), kept.unionByName(fresh)


class FeatureStore:
    """Features and state under a path. ``order`` must be comparable and grow within an entity; its last value is kept."""

    def __init__(self, spark: SparkSession, path: str, entity: str, order: Sequence[str], metrics: Sequence[str], keep: Sequence[str] = (), span: float = 21,
                 roll: int = 5, buckets: int = 64):
        self.spark, self.path, self.entity, self.order, self.metrics = spark, path.rstrip("/"), entity, list(order), list(metrics)
        self.keep, self.span, self.roll, self.buckets = list(keep), span, roll, buckets

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.entity), F.lit(self.buckets)).cast("int")

    def _runs(self) -> tuple[int, list[int]]:
        """Last run, and for each bucket the first run whose files count."""
        runs = self._read("runs")
        if runs is None:
            return -1, [0] * self.buckets
        last = runs.agg(F.max("version")).first()[0]
        first = {r["bucket"]: r["first"] for r in runs.filter(F.col("version") == last).collect()}
        return last, [first[b] for b in range(self.buckets)]

    def features(self) -> DataFrame:
        last, first = self._runs()
        stored = self.spark.read.parquet(f"{self.path}/features")
        return stored.filter((F.col("run") <= last) & (F.col("run") >= F.element_at(F.array(*map(F.lit, first)), F.col("bucket") + 1))).drop("bucket", "run")

    def _made_of(self, rows: DataFrame) -> DataFrame:
        """Per entity its digest and its last place in the order."""
        last = rows.groupBy(self.entity).agg(F.max(F.struct(*self.order)).alias("last"))
        return ST.digest(rows, self.entity).withColumnRenamed(self.entity, "_e").join(last, F.col("_e").eqNullSafe(F.col(self.entity))).drop("_e")

    def update(self, events: DataFrame) -> DataFrame:
        """Bring the store up to date with all rows there are; per entity touched, whether it was ``rebuilt`` or extended."""
        e, run = self.entity, self._runs()[0] + 1
        first = self._runs()[1]
        rows = events.select(e, *self.order, *[F.col(m).cast("double").alias(m) for m in self.metrics], *self.keep)
        made = self._read(f"made_of/version={run - 1}") if run else None
        if made is None:
            earlier = rows.select(e).limit(0)
            fresh_rows, old_rows, state = rows, rows, None
        else:
            known = made.select(F.col(e).alias("_e"), F.col("last"), F.col("rows").alias("_rows"), F.col("digest_a").alias("_a"), F.col("digest_b").alias("_b"))
            placed = rows.join(known, F.col(e).eqNullSafe(F.col("_e")), "left")
            old = placed.filter(F.struct(*self.order) <= F.col("last"))
            now = ST.digest(old.select(*rows.columns), e)
            same = now.withColumnRenamed(e, "_n").join(known, F.col("_n").eqNullSafe(F.col("_e")) & (F.col("rows") == F.col("_rows")) & (F.col("digest_a") == F.col("_a")) & (F.col("digest_b") == F.col("_b")))
            earlier = cut_lineage(same.select(F.col("_e").alias(e)))
            new = placed.filter(F.coalesce(F.struct(*self.order) > F.col("last"), F.lit(True))).select(*rows.columns)
            fresh_rows, old_rows = ST.of_groups(new, earlier, [e]), ST.of_groups(rows, earlier, [e], "left_anti")
            state = ST.of_groups(self.spark.read.parquet(f"{self.path}/state/version={run - 1}"), earlier, [e])
        gone = made.select(e) if made is not None else rows.select(e).limit(0)
        rebuilt = cut_lineage(ST.of_groups(rows.select(e).distinct().unionByName(gone).distinct(), earlier, [e], "left_anti"))
        touched = cut_lineage(rebuilt.withColumn("rebuilt", F.lit(True)).unionByName(fresh_rows.select(e).distinct().withColumn("rebuilt", F.lit(False)) if made is not None
                                                                                     else rebuilt.limit(0).withColumn("rebuilt", F.lit(False))))
        if touched.isEmpty():
            return touched
        parts, states = [], []
        for part, before in ((old_rows, None), (fresh_rows, state)) if made is not None else ((old_rows, None),):
            long = part.unpivot([e, *self.order, *self.keep], self.metrics, METRIC, VALUE)
            features, after = extend(long, before, e, self.order, self.span, self.roll)
            parts.append(features)
            states.append(after)
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        out = out.withColumn("bucket", self._bucket())
        anew = sorted(r["bucket"] for r in rebuilt.select(self._bucket().alias("bucket")).distinct().collect()) if run else []
        if anew:
            stored = self.spark.read.parquet(f"{self.path}/features")
            valid = stored.filter(F.col("bucket").isin(anew) & (F.col("run") < run) & (F.col("run") >= F.element_at(F.array(*map(F.lit, first)), F.col("bucket") + 1)))
            out = out.unionByName(ST.of_groups(valid.drop("run"), rebuilt, [e], "left_anti").select(*out.columns))
        write = lambda df, name, by: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{name}")
        write(out.withColumn("run", F.lit(run)).hint("rebalance", "bucket"), "features", ["bucket", "run"])
        merged = states[0] if len(states) == 1 else states[0].unionByName(states[1])
        merged.write.mode("overwrite").parquet(f"{self.path}/state/version={run}")
        self._made_of(rows).write.mode("overwrite").parquet(f"{self.path}/made_of/version={run}")
        first = [run if b in anew else f for b, f in enumerate(first)]
        base = self.spark.createDataFrame([(run, b, f) for b, f in enumerate(first)], "version int, bucket int, first int")
        write(base, "runs", ["version"])
        if run > 1:
            for name in ("state", "made_of"):
                drop_path(self.spark, f"{self.path}/{name}/version={run - 2}")
        return touched
