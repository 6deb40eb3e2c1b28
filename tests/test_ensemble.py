"""Row-dependent variance, tree members and the fitted blend."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempolith.operators import ensemble as EN
from tempolith.operators import uncertainty as U


def _wavy(spark, n=6000):
    """A mean that is not linear and a spread that grows with x."""
    r = np.random.default_rng(5)
    x, noise = r.uniform(-2, 2, n), r.normal(size=n)
    y = np.where(x > 0, 3 * x, -x) + np.exp(0.6 * x - 0.5) * noise
    rows = [(i, float(a), float(b), None if i % 10 == 0 else float(b) + 1, float(np.mean(y))) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x double, y double, gaps double, prior double").withColumn("late", F.col("id") % 3 == 0)


def _thirds(spark, df, model):
    s = U.summarize_draws(EN.draws(df, "id", model), ["id", "target"]).join(df.select("id", "y"), "id")
    rows = U.intervals(s, "target", clamp_zero=False).select("y", "std80_lower", "std80_upper", "std_predictive").toPandas().sort_values("std_predictive")
    inside = rows.y.between(rows.std80_lower, rows.std80_upper).to_numpy()
    return [part.mean() for part in np.array_split(inside, 3)], rows.std_predictive.iloc[[0, -1]].tolist()


def test_trees_cover_in_every_third_of_the_spread(spark):
    df = _wavy(spark)
    model = EN.fit(df.filter("NOT late"), "id", ["x"], ["y"], linear=0, trees=4)
    cover, (narrow, wide) = _thirds(spark, df.filter("late"), model)
    assert all(0.75 <= c <= 0.85 for c in cover), cover
    assert wide > 3 * narrow


def test_linear_variance_covers_where_the_mean_is_linear(spark):
    r = np.random.default_rng(6)
    x = r.uniform(-2, 2, 6000)
    y = 2 * x + 1 + np.exp(0.7 * x) * r.normal(size=6000)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x double, y double")
    model = EN.fit(df.filter("id % 3 != 0"), "id", ["x"], ["y"], linear=6, trees=0)
    assert all(abs(g[1] - 1.4) < 0.15 and abs(g[0]) < 0.25 for _, _, _, g, _ in model.linear)
    cover, _ = _thirds(spark, df.filter("id % 3 = 0"), model)
    assert 0.75 <= cover[0] <= 0.85 and 0.75 <= cover[2] <= 0.85, cover


def test_blend_is_least_squares_on_held_out_rows(spark):
    r = np.random.default_rng(7)
    y, p, q = (r.normal(size=500) for _ in range(3))
    pred, prior = y + p, y + 0.5 * q
    rows = [("t", *map(float, v)) for v in zip(y, pred, prior)] + [("t", 1.0, 2.0, None), ("t", None, 2.0, 1.0), ("same", 3.0, 1.0, 1.0)]
    got = {r.target: r for r in EN.fit_blend(spark.createDataFrame(rows, "target string, y double, pred double, prior double"), "target", "y", "pred", "prior").collect()}
    want = ((y - prior) @ (pred - prior)) / ((pred - prior) @ (pred - prior))
    assert got["t"].own == pytest.approx(want) and got["t"].n == 500 and got["same"].own == 1.0
    grid = np.linspace(0, 1, 1001)
    assert abs(grid[np.argmin([((y - a * pred - (1 - a) * prior) ** 2).sum() for a in grid])] - got["t"].own) < 1e-3


def test_saved_model_draws_the_same_and_missing_values_pass(spark, tmp_path):
    df = _wavy(spark, 1500)
    model = EN.with_blend(EN.fit(df.filter("NOT late"), "id", ["x"], ["y", "gaps"], linear=2, trees=1, leaf_rows=20), df.filter("late"), "id", {"y": "prior"})
    assert 0 <= model.own["y"] <= 1 and "gaps" not in model.own
    EN.save(model, spark, str(tmp_path / "m"))
    again = EN.load(spark, str(tmp_path / "m"))
    odd = spark.createDataFrame([(1, None, None), (2, float("-1e9"), 4.0)], "id long, x double, prior double")
    a, b = (sorted(map(tuple, EN.draws(odd, "id", m, priors={"y": "prior"}).collect()), key=str) for m in (model, again))
    assert a == b and len(a) == 2 * 2 * 3
    assert EN.draws(odd.limit(0), "id", model).count() == 0


def test_constant_target_and_tiny_tables(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(3)], "id long, x double, y double")
    model = EN.fit(df, "id", ["x"], ["y"], linear=2, trees=1)
    rows = EN.draws(df, "id", model).collect()
    assert rows and all(np.isfinite([r.mean, r.logvar, r.sample]).all() for r in rows)


def _counted(spark, n):
    """Rows with a feature and a target, and how many of them were computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def passing(i):
        seen.add(1)
        return float(i % 17)

    return spark.range(n).select(F.col("id"), F.udf(passing, "double")("id").alias("x"), (F.col("id") % 17 + F.col("id") % 5).cast("double").alias("y")), seen


def test_rows_are_computed_once_for_all_members(spark):
    df, seen = _counted(spark, 400)
    model = EN.fit(df, "id", ["x"], ["y"], linear=2, trees=1, depth=2, leaf_rows=10)
    assert len(model.linear) == 2 and len(model.trees) == 1
    assert seen.value <= 800, "every pass of the fits computes the rows again"


def test_scoring_artifacts_compute_their_rows_once(spark):
    from tempolith.plans import jobs as J
    from tempolith.session import scratch_path
    df, seen = _counted(spark, 400)
    J.fit_scoring(df.withColumn("other", F.lit("unused")), "id", ["y"], scratch_path(spark, "t_scoring_once"), members=2, numeric=["x"])
    assert seen.value <= 800, "every pass of the fits computes the rows again"
