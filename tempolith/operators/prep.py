"""Feature preparation (M1-M13) as Spark jobs.

Fitted state is always a small parameter table (one row of moments, a
category list, a grid) that is joined back - never a driver loop over data.
Category vocabularies are numbered with a distributed global index (range
partitioned sort + per-partition offsets), so even a large vocabulary never
lands in a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolith.functions.numeric import clip


# M1 -----------------------------------------------------------------------------
def temporal_split(df: DataFrame, season: str, cutoff, valid_on_or_after: bool = False):
    """train = season < cutoff; valid = season == cutoff (or >= with the flag)."""
    train = df.filter(F.col(season) < cutoff)
    valid = df.filter(F.col(season) >= cutoff) if valid_on_or_after else df.filter(F.col(season) == cutoff)
    return train, valid


# distributed ordinal -----------------------------------------------------------------
def global_index(values: DataFrame, col: str, out: str = "idx", start: int = 1) -> DataFrame:
    """Number the distinct values of ``col`` in sort order, ``start``, ``start+1``, ...

    Range-partition by value, number rows inside each partition, and add the
    row counts of all earlier partitions (a table with one row per partition).
    """
    from tempolith.session import cut_lineage
    d = values.select(col).filter(F.col(col).isNotNull()).distinct()
    # the partition id is physical: checkpoint so every branch sees one assignment
    d = cut_lineage(d.repartitionByRange(col).withColumn("_pid", F.spark_partition_id()))
    local = d.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(col)))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .select(col, (F.col("_off") + F.col("_rn") + F.lit(start - 1)).cast("int").alias(out)))


# M2 -----------------------------------------------------------------------------
def fit_index(train: DataFrame, col: str) -> DataFrame:
    """Sorted train categories -> 1..n (as strings, so numbers and text share one path)."""
    return global_index(train.select(F.col(col).cast("string").alias(col)), col, out=f"{col}_idx")


def apply_index(df: DataFrame, index: DataFrame, col: str) -> DataFrame:
    """Unseen or NULL categories -> 0."""
    j = df.withColumn("_key", F.col(col).cast("string")).join(
        index.withColumnRenamed(col, "_key"), "_key", "left").drop("_key")
    return j.withColumn(f"{col}_idx", F.coalesce(F.col(f"{col}_idx"), F.lit(0)))


# M3 -----------------------------------------------------------------------------
def index_stats(index: DataFrame, applied_valid: DataFrame, col: str) -> DataFrame:
    """One row: seen categories, embedding rows (n + 1), embedding width
    ``min(50, max(4, floor(sqrt(n + 1))))`` and the validation unknown rate."""
    unk = applied_valid.agg(F.avg((F.col(f"{col}_idx") == 0).cast("double"))).scalar()
    out = index.agg(F.count(F.lit(1)).alias("n_seen")).withColumns({"unknown_rate": unk, "feature": F.lit(col)})
    return out.select("feature", "n_seen", (F.col("n_seen") + 1).alias("num_embeddings"),
                      F.least(F.lit(50), F.greatest(F.lit(4), F.floor(F.sqrt(F.col("n_seen") + 1)).cast("int")))
                      .alias("embedding_dim"), "unknown_rate")


# M4 -----------------------------------------------------------------------------
def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row table of mean and population std per column (zero std -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sd")]
    p = df.agg(*aggs)
    return p.withColumns({f"{c}__scale": F.when((F.col(f"{c}__sd") > 0), F.col(f"{c}__sd")).otherwise(F.lit(1.0))
                          for c in cols}).drop(*[f"{c}__sd" for c in cols])


def one_row(params: DataFrame):
    """A fitted one-row parameter table as a single scalar subquery (a struct):
    the fit runs once, every row reads the values, no join."""
    return params.select(F.struct(*params.columns)).scalar()


def scale(df: DataFrame, params: DataFrame, cols: Sequence[str], inverse: bool = False) -> DataFrame:
    """Standardise (or undo it) with a fitted one-row parameter table."""
    p = one_row(params)
    if inverse:
        exprs = {c: F.col(c) * p[f"{c}__scale"] + p[f"{c}__mean"] for c in cols}
    else:
        exprs = {c: (F.col(c) - p[f"{c}__mean"]) / p[f"{c}__scale"] for c in cols}
    return df.withColumns(exprs)


# M5 -----------------------------------------------------------------------------
def prepare_priors(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> 0, then standardise with moments fitted on the (filled) train frame."""
    params = fit_scaler(train.fillna(0.0, subset=list(cols)), cols)
    return scale(df.fillna(0.0, subset=list(cols)), params, cols)


# M6 -----------------------------------------------------------------------------
#: The sketch that brackets a median errs by at most 1 / SKETCH of all rows; shares of rows taken on either side, the
#: next one where a bracket has missed.
SKETCH, AROUND = 10000, (0.0005, 0.02, 1.0)


def exact_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the exact median (mean of the two middle values) of each column.

    The rows are neither shuffled nor sorted: one pass counts each column's values
    and brackets its middle by a sketch, a second counts the values below the
    bracket (a sum per task) and those inside it by value. Of these, about a
    thousandth of the rows, running counts pick the one or two middle values. NaN
    sorts last and stays out of the sketch."""
    whole = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    own = [F.when(~F.isnan(f"_{i}"), F.col(f"_{i}")) for i in range(len(cols))]

    def bracket(i: int, lo: float, hi: float):
        return F.percentile_approx(own[i], [max(lo, 0.0), min(hi, 1.0)], SKETCH).alias(f"at_{i}")

    got = whole.agg(*[F.count(f"_{i}").alias(f"all_{i}") for i in range(len(cols))], *[F.count(v).alias(f"n_{i}") for i, v in enumerate(own)],
                    *[bracket(i, 0.5 - AROUND[0], 0.5 + AROUND[0]) for i in range(len(cols))]).first()
    n = [got[f"n_{i}"] for i in range(len(cols))]
    ranks = {i: ((k + 1) // 2, k // 2 + 1) for i in range(len(cols)) if (k := got[f"all_{i}"])}
    medians = {i: math.nan for i, (_, hi) in ranks.items() if hi > n[i]}
    bounds = {i: got[f"at_{i}"] for i in ranks if n[i] == got[f"all_{i}"]}
    for width in AROUND:
        ranks = {i: r for i, r in ranks.items() if i not in medians}
        if not ranks:
            break
        unknown = [i for i in ranks if i not in bounds]
        if unknown:
            found = whole.agg(*[bracket(i, ranks[i][0] / n[i] - width, ranks[i][1] / n[i] + width) for i in unknown]).first()
            bounds |= {i: found[f"at_{i}"] for i in unknown}
        medians |= _middles(whole, ranks, bounds)
        bounds = {}
    return df.sparkSession.createDataFrame([tuple(medians.get(i) for i in range(len(cols)))], T.StructType([T.StructField(f"{c}__median", T.DoubleType()) for c in cols]))


def _middles(whole: DataFrame, ranks: dict[int, tuple[int, int]], bounds: dict[int, Sequence[float]]) -> dict[int, float]:
    """Medians by column number; a column whose middle ranks lie outside its bounds is left out."""
    each = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"_{i}").alias("_v"), F.lit(bounds[i][0]).alias("_from"), F.lit(bounds[i][1]).alias("_to"),
                              F.lit(lo).cast("long").alias("_lo"), F.lit(hi).cast("long").alias("_hi")) for i, (lo, hi) in ranks.items()])
    vals = whole.select(F.explode(each).alias("_e")).select("_e.*").filter(F.col("_v") <= F.col("_to"))
    counts = vals.groupBy("_c", "_lo", "_hi", F.when(F.col("_v") >= F.col("_from"), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    run = counts.withColumn("_run", F.sum("_n").over(Window.partitionBy("_c").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)))
    near = run.filter((F.col("_run") >= F.col("_lo")) & (F.col("_run") - F.col("_n") < F.col("_hi")) & F.col("_v").isNotNull()).collect()
    out = {}
    for i, pair in ranks.items():
        at = [[r["_v"] for r in near if r["_c"] == i and r["_run"] - r["_n"] < k <= r["_run"]] for k in pair]
        if all(at):
            out[i] = (at[0][0] + at[1][0]) / 2.0
    return out


def exact_median(df: DataFrame, col: str) -> DataFrame:
    return exact_medians(df, [col])


def fill_medians(df: DataFrame, medians: DataFrame, cols: Sequence[str]) -> DataFrame:
    m = one_row(medians)
    return df.withColumns({c: F.coalesce(F.col(c), m[f"{c}__median"]) for c in cols})


def median_impute(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fill_medians(df, exact_medians(train, cols), cols)


def kept_components(model, variance: float) -> int:
    """Smallest number of components whose explained variance reaches ``variance``."""
    total, ratios = 0.0, list(model.explainedVariance)
    for k, v in enumerate(ratios, 1):
        total += v
        if total >= variance - 1e-12:
            return k
    return len(ratios)


def prepare_numeric(train: DataFrame, df: DataFrame, cols: Sequence[str], variance: float = 0.95,
                    out: str = "pca"):
    """Median impute -> standardise -> PCA keeping ``variance`` of the variance.

    Medians and moments are fitted on the train frame, the PCA once with all
    components, of which the first k stay (their signs are arbitrary).
    Returns (frame with a vector column ``out``, k).
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    medians = exact_medians(train, cols)
    tr = fill_medians(train, medians, cols)
    params = fit_scaler(tr, cols)
    va = VectorAssembler(inputCols=list(cols), outputCol="_vec")
    model = PCA(k=len(cols), inputCol="_vec", outputCol=out).fit(va.transform(scale(tr, params, cols)))
    k = kept_components(model, variance)
    done = model.transform(va.transform(scale(fill_medians(df, medians, cols), params, cols)))
    return done.withColumn(out, array_to_vector(F.slice(vector_to_array(out), 1, k))).drop("_vec"), k


# M7 -----------------------------------------------------------------------------
def one_hot_vector(train: DataFrame, df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One-hot encoding for any number of train categories: a sparse vector
    ``struct<size, index, value>`` per row.  Categories (as strings, NULL ->
    'missing') are numbered by a distributed index; a binary feature keeps only
    its second category; an unseen value has no index."""
    key = F.coalesce(F.col(col).cast("string"), F.lit("missing"))
    index = global_index(train.select(key.alias("_cat")), "_cat", "_idx", start=0)
    size = index.agg(F.count(F.lit(1)).alias("_size"))
    j = df.withColumn("_key", key).join(index, F.col("_key") == F.col("_cat"), "left").join(F.broadcast(size))   # one row
    width = F.when(F.col("_size") == 2, 1).otherwise(F.col("_size")).cast("int")
    at = F.when(F.col("_size") == 2, F.when(F.col("_idx") == 1, 0)).otherwise(F.col("_idx")).cast("int")
    vec = F.struct(width.alias("size"), at.alias("index"), F.when(at.isNotNull(), 1.0).otherwise(0.0).alias("value"))
    return j.withColumn(out or f"{col}_onehot", vec).drop("_key", "_cat", "_idx", "_size")


def one_hot(train: DataFrame, df: DataFrame, col: str, max_categories: int = 1000) -> DataFrame:
    """Indicator columns for the train categories (cast to string, NULL ->
    'missing'); a binary feature keeps only the second category; unseen
    values get all zeros.  One column per category suits few of them; beyond
    ``max_categories`` this raises, and ``one_hot_vector`` has no limit."""
    key = F.coalesce(F.col(col).cast("string"), F.lit("missing"))
    cats = [r[0] for r in train.select(key.alias("_c")).distinct().orderBy("_c").limit(max_categories + 1).collect()]
    if len(cats) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories; use one_hot_vector")
    if len(cats) == 2:
        cats = cats[1:]
    return df.withColumns({f"{col}_{c}": (key == F.lit(c)).cast("double") for c in cats})


# M8 -----------------------------------------------------------------------------
def variance_filter(df: DataFrame, cols: Sequence[str], threshold: float = 1e-4) -> list[str]:
    """Columns whose population variance exceeds ``threshold`` (one aggregate)."""
    row = df.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > threshold]


# M10 ----------------------------------------------------------------------------
def dampen(df: DataFrame, targets: Sequence[str], recent_minutes: str | None, long_minutes: str | None,
           mean_fmt: str = "{t}_exp_mean", std_fmt: str = "{t}_exp_std", recent_fmt: str = "{t}_ewm_mean",
           lo: float = 0.2, hi: float = 1.0, eps: float = 1e-6) -> DataFrame:
    """Shrink prior means by w and widen prior stds by (2 - w).

    w = min(clip(recent/long minutes), clip(recent/long target)), the target
    ratio defaulting to 1 when undefined; a NULL minutes ratio gives NULL w."""
    if recent_minutes and long_minutes:
        mr = clip(F.col(recent_minutes) / (F.col(long_minutes) + F.lit(eps)), lo, hi)
    else:
        mr = F.lit(1.0)
    out = {}
    for t in targets:
        m, s, r = mean_fmt.format(t=t), std_fmt.format(t=t), recent_fmt.format(t=t)
        if m not in df.columns:
            continue
        if r in df.columns:
            pr = clip(F.coalesce(F.try_divide(F.col(r), F.when(F.col(m) != 0, F.col(m))), F.lit(1.0)), lo, hi)
            w = F.when(mr.isNotNull(), F.least(mr, pr))
        else:
            w = mr
        out[m] = F.col(m) * w
        if s in df.columns:
            out[s] = F.col(s) * (F.lit(2.0) - w)
    return df.withColumns(out)


# M11 ----------------------------------------------------------------------------
def breakout_label(df: DataFrame, y: str, mean: str, std: str, out: str = "breakout") -> DataFrame:
    """1 when y exceeds mean + std; ``{out}_valid`` marks rows where all three are finite."""
    tau = F.col(mean) + F.col(std)
    valid = F.col(y).isNotNull() & tau.isNotNull() & ~F.isnan(F.col(y)) & ~F.isnan(tau)
    return df.withColumns({out: F.when(valid, (F.col(y) > tau).cast("int")).otherwise(F.lit(0)),
                           f"{out}_valid": valid.cast("int")})


# M12 ----------------------------------------------------------------------------
def balance_weights(df: DataFrame, group, label: str, valid: str, out: str = "weight") -> DataFrame:
    """Per group positive rate p (clamped to [1e-6, 1-1e-6]); positives weigh
    1 - p, negatives p, invalid rows 0."""
    from tempolith.operators.aggs import _with_group
    rate = F.sum(F.col(label) * F.col(valid)) / F.greatest(F.sum(valid), F.lit(1))
    d = _with_group(df, [group] if isinstance(group, str) else list(group), rate, "_p")
    p = F.least(F.greatest(F.col("_p"), F.lit(1e-6)), F.lit(1 - 1e-6))
    wt = (F.col(label) * (F.lit(1.0) - p) + (F.lit(1) - F.col(label)) * p) * F.col(valid)
    return d.withColumn(out, wt).drop("_p")


# M13 ----------------------------------------------------------------------------
def hash_split(df: DataFrame, key: str, frac: float = 0.5, seed: int = 42, out: str = "is_cal",
               buckets: int = 1 << 20) -> DataFrame:
    """Deterministic split: rows whose hashed key falls below ``frac`` go to the
    calibration half; stable across runs, partitionings and executor loss."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") % F.lit(buckets)
    return df.withColumn(out, h < F.lit(int(math.floor(frac * buckets))))
