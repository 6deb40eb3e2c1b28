"""Uncertainty regression (M14): bootstrap members with a mean and a row-dependent log-variance, blended with priors.

Three stages, all on hashed bootstrap weights, so every run gives the same model:

* means: linear members (``uncertainty.fit_ensemble``, closed form) and tree members (Spark ML regression trees with the
  Poisson(1) weights as instance weights), which follow what is not linear;
* log-variance: each member's residuals on the rows that its own bootstrap left out (weight 0, about 37 %) say how wide
  it errs where it has not looked. Their log squares are regressed on the features - linear members in closed form,
  shifted so that squared residuals over predicted variances average to 1; tree members by a second tree, each leaf
  of which then gets the mean square of its residuals;
* blend: per target the share of the prediction against a prior mean that leaves the least squared error on held-out
  rows, in closed form, between 0 and 1.

A missing feature counts as 0, rows without a target are left out of the fits. A member whose bootstrap leaves no row
out, or too few to solve for the slopes, gets the constant log-variance of its residuals on all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.operators import uncertainty as U
from tempolith.session import keep_rows

#: Squared residuals count as at least this; log-variances stay within so many nats of the member's constant one.
FLOOR, LIMIT = 1e-12, 5.0


@dataclass
class Tree:
    target: str
    draw: int
    mean: DecisionTreeRegressionModel
    logvar: DecisionTreeRegressionModel | None
    #: log-variance of each leaf of ``logvar``, by its index
    leaves: list[float]
    constant: float


@dataclass
class Ensemble:
    features: list[str]
    targets: list[str]
    #: (target, draw, [intercept, *slopes], [intercept, *slopes] of the log-variance, constant log-variance)
    linear: list[tuple[str, int, list[float], list[float], float]] = field(default_factory=list)
    trees: list[Tree] = field(default_factory=list)
    own: dict[str, float] = field(default_factory=dict)


def bootstrap_weight(seed: int, row: Column, draw: Column) -> Column:
    """The Poisson(1) weight of a row in a member's bootstrap (as in ``uncertainty.fit_ensemble``)."""
    return U.poisson1(U.hashed_uniform(seed, row, draw))


def _inputs(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]


def _linear(beta: Sequence[float], z: Sequence[Column]) -> Column:
    out = F.lit(float(beta[0]))
    for b, x in zip(beta[1:], z):
        out = out + F.lit(float(b)) * x
    return out


def _within(logvar: Column, constant) -> Column:
    return F.greatest(F.least(logvar, constant + F.lit(LIMIT)), constant - F.lit(LIMIT))


# log-variance of linear members ---------------------------------------------------------------------
def fit_log_variance(train: DataFrame, row: str, features: Sequence[str], targets: Sequence[str], fitted,
                     seed: int = 7) -> list[tuple[str, int, list[float], list[float], float]]:
    """Members of ``fit_ensemble`` with a log-variance that is linear in the features.

    Two passes over the rows that each member left out: cross products of the features and log squared residuals
    (map-side sums, one small row per member), then the mean ratio that shifts the intercept."""
    import numpy as np

    z = _inputs(features)
    p = len(z) + 1
    members = [F.struct(F.lit(t).alias("t"), F.lit(m).alias("m"), (F.col(t).cast("double") - _linear(beta, z)).alias("e")) for t, m, beta, _ in fitted]
    left = (train.select(F.col(row).alias("_row"), F.array(F.lit(1.0), *z).alias("_z"), F.explode(F.array(*members)).alias("_r")).select("_row", "_z", "_r.*")
            .filter(F.col("e").isNotNull()).filter(bootstrap_weight(seed, F.col("_row"), F.col("m")) == 0)
            .withColumn("_l", F.log(F.greatest(F.col("e") * F.col("e"), F.lit(FLOOR)))))
    at = [F.col("_z")[i] for i in range(p)]
    sums = {f"zz_{i}_{j}": F.sum(at[i] * at[j]) for i in range(p) for j in range(i, p)} | {f"zl_{i}": F.sum(at[i] * F.col("_l")) for i in range(p)}
    got = {(r["t"], r["m"]): r for r in left.groupBy("t", "m").agg(*[e.alias(k) for k, e in sums.items()]).collect()}
    gammas: dict[tuple, list[float]] = {}
    for t, m, _, constant in fitted:
        r = got.get((t, m))
        zz = np.array([[r[f"zz_{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)]) if r else None
        if r and np.linalg.matrix_rank(zz) == p:
            gammas[t, m] = np.linalg.solve(zz, np.array([r[f"zl_{i}"] for i in range(p)])).tolist()
        else:
            gammas[t, m] = [float(constant)] + [0.0] * (p - 1)
    if not gammas:
        return []
    table = F.create_map(*[x for (t, m), g in gammas.items() for x in (F.lit(f"{t}:{m}"), F.array(*map(F.lit, g)))])
    gamma = table[F.concat_ws(":", "t", "m")]
    logvar = sum((gamma[i] * at[i] for i in range(1, p)), gamma[0])
    ratio = {(r["t"], r["m"]): r["r"] for r in left.groupBy("t", "m").agg(F.avg(F.col("e") * F.col("e") / F.exp(logvar)).alias("r")).collect()}
    out = []
    for t, m, beta, constant in fitted:
        g = gammas[t, m]
        if (t, m) in got and ratio.get((t, m)) and any(g[1:]) and math.isfinite(ratio[t, m]):
            g = [g[0] + math.log(ratio[t, m])] + g[1:]
        out.append((t, m, list(beta), g, float(constant)))
    return out


# tree members ---------------------------------------------------------------------------------------
def fit_tree_members(train: DataFrame, row: str, features: Sequence[str], targets: Sequence[str], members: int, first: int = 0, depth: int = 5,
                     leaf_rows: int = 50, seed: int = 7) -> list[Tree]:
    """Regression trees on bootstrap weights, each with a second tree for its log-variance on the rows it left out."""
    z = _inputs(features)
    rows = train.select(F.col(row).alias("_row"), *[x.alias(f"_x{i}") for i, x in enumerate(z)], *[F.col(t).cast("double").alias(f"_y_{t}") for t in targets])
    rows = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(z))], outputCol="_vec").transform(rows).select("_row", "_vec", *[f"_y_{t}" for t in targets])
    out = []
    for t in targets:
        known = rows.filter(F.col(f"_y_{t}").isNotNull()).withColumnRenamed(f"_y_{t}", "_y").select("_row", "_vec", "_y")
        for m in range(first, first + members):
            drawn = known.withColumn("_w", bootstrap_weight(seed, F.col("_row"), F.lit(m)))
            base = DecisionTreeRegressor(featuresCol="_vec", labelCol="_y", predictionCol="_p", weightCol="_w", maxDepth=depth, minInstancesPerNode=leaf_rows, seed=seed)
            fit_rows = drawn.filter("_w > 0")
            if fit_rows.isEmpty():
                continue
            mean = base.fit(fit_rows)
            left = mean.transform(drawn.filter("_w = 0")).withColumn("_e2", F.pow(F.col("_y") - F.col("_p"), 2)).drop("_p")
            left = left.withColumn("_l", F.log(F.greatest(F.col("_e2"), F.lit(FLOOR))))
            spread = left.agg(F.avg("_e2").alias("v"), F.count(F.lit(1)).alias("n")).first()
            constant = math.log(max(spread.v or 0.0, FLOOR))
            if (spread.n or 0) < 2 * leaf_rows:
                out.append(Tree(t, m, mean, None, [], constant))
                continue
            wide = DecisionTreeRegressor(featuresCol="_vec", labelCol="_l", predictionCol="_lv", leafCol="_leaf", maxDepth=depth, minInstancesPerNode=leaf_rows, seed=seed).fit(left)
            held = {int(r["_leaf"]): r["v"] for r in wide.transform(left).groupBy("_leaf").agg(F.avg("_e2").alias("v")).collect()}
            leaves = [math.log(max(held.get(k, math.exp(constant)), FLOOR)) for k in range(wide.numNodes)]
            out.append(Tree(t, m, mean, wide, leaves, constant))
    return out


# blend ----------------------------------------------------------------------------------------------
def fit_blend(held_out: DataFrame, target: str, y: str, predicted: str, prior: str) -> DataFrame:
    """Per target: ``own``, the share of the prediction in own * prediction + (1 - own) * prior that leaves the least
    squared error, and the rows it rests on. Rows without a prior take no part; 1 where the two never differ."""
    away, gap = F.col(predicted) - F.col(prior), F.col(y) - F.col(prior)
    known = held_out.filter(F.col(y).isNotNull() & F.col(predicted).isNotNull() & F.col(prior).isNotNull())
    own = F.coalesce(F.try_divide(F.sum(gap * away), F.sum(away * away)), F.lit(1.0))
    return known.groupBy(target).agg(F.greatest(F.least(own, F.lit(1.0)), F.lit(0.0)).alias("own"), F.count(F.lit(1)).alias("n"))


# whole model ----------------------------------------------------------------------------------------
def fit(train: DataFrame, row: str, features: Sequence[str], targets: Sequence[str], linear: int = 5, trees: int = 5, depth: int = 5, leaf_rows: int = 50,
        seed: int = 7, ridge: float = 0.0, kept: bool = False) -> Ensemble:
    """Linear members, numbered from 0, and tree members after them.

    Every member takes several passes over the rows, so what they need of ``train`` is computed once, unless it is
    ``kept`` already."""
    train = train if kept else keep_rows(train.select(*dict.fromkeys([row, *features, *targets])), row)
    members = U.fit_ensemble(train, row, features, targets, members=linear, seed=seed, ridge=ridge) if linear else []
    return Ensemble(list(features), list(targets), fit_log_variance(train, row, features, targets, members, seed) if members else [],
                    fit_tree_members(train, row, features, targets, trees, first=linear, depth=depth, leaf_rows=leaf_rows, seed=seed) if trees else [])


def draws(df: DataFrame, row: str, model: Ensemble, seed: int = 7, priors: dict[str, str] | None = None) -> DataFrame:
    """Long table of member predictions: (row, target, draw, mean, logvar, sample), as ``uncertainty.score_draws``.

    ``priors`` names a prior mean column per target, with which the mean is blended by the model's fitted share."""
    z = _inputs(model.features)
    names = list(dict.fromkeys((priors or {}).values()))
    rows = df.select(F.col(row), *[x.alias(f"_x{i}") for i, x in enumerate(z)], *[F.col(p).cast("double").alias(f"_p_{p}") for p in names])
    x = [F.col(f"_x{i}") for i in range(len(z))]
    found: list[tuple[str, int, Column, Column]] = []
    for t, m, beta, gamma, constant in model.linear:
        found.append((t, m, _linear(beta, x), _within(_linear(gamma, x), F.lit(constant))))
    if model.trees:
        rows = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(z))], outputCol="_vec").transform(rows)
        for k, tree in enumerate(model.trees):
            rows = tree.mean.copy({tree.mean.predictionCol: f"_m{k}"}).transform(rows)
            logvar = F.lit(tree.constant)
            if tree.logvar is not None:
                rows = tree.logvar.copy({tree.logvar.predictionCol: f"_v{k}", tree.logvar.leafCol: f"_leaf{k}"}).transform(rows)
                logvar = _within(F.array(*map(F.lit, tree.leaves))[F.col(f"_leaf{k}").cast("int")], F.lit(tree.constant))
            found.append((tree.target, tree.draw, F.col(f"_m{k}"), logvar))
    each = []
    for t, m, mean, logvar in found:
        if priors and t in priors:
            own = F.lit(float(model.own.get(t, 1.0)))
            mean = F.coalesce(own * mean + (F.lit(1.0) - own) * F.col(f"_p_{priors[t]}"), mean)
        each.append(F.struct(F.lit(t).alias("target"), F.lit(m).alias("draw"), mean.alias("mean"), logvar.alias("logvar")))
    if not each:
        return U.with_samples(rows.select(F.col(row), F.lit("").alias("target"), F.lit(0).alias("draw"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("logvar")).limit(0), row, seed)
    return U.with_samples(rows.select(F.col(row), F.explode(F.array(*each)).alias("_d")).select(row, "_d.*"), row, seed)


def with_blend(model: Ensemble, held_out: DataFrame, row: str, priors: dict[str, str]) -> Ensemble:
    """The model with blend shares fitted on held-out rows that hold the targets and their priors."""
    mean = draws(held_out, row, model).groupBy(row, "target").agg(F.avg("mean").alias("_pred"))
    known = held_out.select(row, F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("_y"), F.col(p).cast("double").alias("_prior")) for t, p in priors.items()])).alias("_k")).select(row, "_k.*")
    own = {r["target"]: r["own"] for r in fit_blend(mean.join(known, [row, "target"]), "target", "_y", "_pred", "_prior").collect()}
    return Ensemble(model.features, model.targets, model.linear, model.trees, own)


# saved form -----------------------------------------------------------------------------------------
def save(model: Ensemble, spark: SparkSession, path: str) -> None:
    """Coefficients and shares as tables, trees as Spark ML models beside them."""
    spark.createDataFrame([(i, f, "feature") for i, f in enumerate(model.features)] + [(i, t, "target") for i, t in enumerate(model.targets)],
                          "position int, name string, kind string").write.mode("overwrite").parquet(f"{path}/names")
    spark.createDataFrame([(t, m, [float(b) for b in beta], [float(g) for g in gamma], float(c)) for t, m, beta, gamma, c in model.linear],
                          "target string, draw int, beta array<double>, gamma array<double>, constant double").write.mode("overwrite").parquet(f"{path}/linear")
    spark.createDataFrame([(k, t.target, t.draw, t.logvar is not None, t.leaves, t.constant) for k, t in enumerate(model.trees)],
                          "position int, target string, draw int, wide boolean, leaves array<double>, constant double").write.mode("overwrite").parquet(f"{path}/trees")
    spark.createDataFrame(list(model.own.items()), "target string, own double").write.mode("overwrite").parquet(f"{path}/own")
    for k, tree in enumerate(model.trees):
        tree.mean.write().overwrite().save(f"{path}/tree_{k}_mean")
        if tree.logvar is not None:
            tree.logvar.write().overwrite().save(f"{path}/tree_{k}_logvar")


def load(spark: SparkSession, path: str) -> Ensemble:
    names = spark.read.parquet(f"{path}/names").orderBy("position").collect()
    trees = []
    for r in spark.read.parquet(f"{path}/trees").orderBy("position").collect():
        wide = DecisionTreeRegressionModel.load(f"{path}/tree_{r.position}_logvar") if r.wide else None
        trees.append(Tree(r.target, r.draw, DecisionTreeRegressionModel.load(f"{path}/tree_{r.position}_mean"), wide, list(r.leaves), r.constant))
    linear = [(r.target, r.draw, list(r.beta), list(r.gamma), r.constant) for r in spark.read.parquet(f"{path}/linear").orderBy("target", "draw").collect()]
    own = {r.target: r.own for r in spark.read.parquet(f"{path}/own").collect()}
    return Ensemble([r["name"] for r in names if r.kind == "feature"], [r["name"] for r in names if r.kind == "target"], linear, trees, own)
