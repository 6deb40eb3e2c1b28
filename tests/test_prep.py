"""Feature preparation and calibration operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempolith.operators import prep as P
from tempolith.operators import uncertainty as U


def test_global_index_sorted_dense(spark):
    vals = spark.createDataFrame([(v,) for v in ["b", "a", "c", "a", None, "b"]], "c string")
    got = {r.c: r.idx for r in P.global_index(vals, "c").collect()}
    assert got == {"a": 1, "b": 2, "c": 3}


def test_apply_index_unseen_is_zero(spark):
    tr = spark.createDataFrame([("x",), ("y",)], "c string")
    df = spark.createDataFrame([(1, "y"), (2, "z"), (3, None)], "i int, c string")
    got = {r.i: r.c_idx for r in P.apply_index(df, P.fit_index(tr, "c"), "c").collect()}
    assert got == {1: 2, 2: 0, 3: 0}


@pytest.mark.parametrize("n", [1, 2, 7, 10, 1001])
def test_exact_median(spark, n):
    x = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    assert P.exact_median(df, "v").first()[0] == pytest.approx(float(np.median(x)))


def test_exact_medians_sort_only_the_middle(spark, monkeypatch):
    n = 30001
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("a"), F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("ties"),
                               F.when(F.col("id") % 4 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("some nan"), F.lit(None).cast("double").alias("none"),
                               F.when(F.col("id") % 3 > 0, float("nan")).otherwise(1.0).alias("most_nan"), F.when(F.col("id") < n // 2, -1e300).otherwise(F.col("id")).alias("halves"))
    monkeypatch.setattr(type(df), "repartitionByRange", lambda *a: pytest.fail("all rows are dealt by value and sorted"))
    got = P.exact_medians(df, df.columns).first()
    rest = sorted(i for i in range(n) if i % 4)
    assert got.asDict() | {"most_nan__median": None} == {"a__median": 15000.0, "ties__median": 5.0, "some nan__median": float(rest[n // 2]), "none__median": None,
                                                         "most_nan__median": None, "halves__median": 15000.0}
    assert np.isnan(got["most_nan__median"])
    # a bracket that misses is widened
    monkeypatch.setattr(P, "AROUND", (0.0, 1.0))
    assert P.exact_medians(df.filter("a < 30000"), ["a"]).first()[0] == 14999.5


def test_scaler_uses_population_std_and_zero_variance_scale_one(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    out = P.scale(df, P.fit_scaler(df, ["a", "b"]), ["a", "b"]).toPandas()
    a = np.array([1.0, 2.0, 4.0])
    assert np.allclose(out["a"], (a - a.mean()) / a.std(ddof=0))
    assert (out["b"] == 0).all()
    back = P.scale(P.scale(df, P.fit_scaler(df, ["a"]), ["a"]), P.fit_scaler(df, ["a"]), ["a"], inverse=True)
    assert np.allclose(back.toPandas()["a"], a)


def test_one_hot_binary_and_unseen(spark):
    tr = spark.createDataFrame([("no",), ("yes",), (None,)], "u string")
    df = spark.createDataFrame([("yes",), ("maybe",), (None,)], "u string")
    out = P.one_hot(tr, df, "u").toPandas()
    assert list(out.columns) == ["u", "u_missing", "u_no", "u_yes"]
    tr2 = spark.createDataFrame([("no",), ("yes",)], "u string")
    out2 = P.one_hot(tr2, df, "u").toPandas()
    assert list(out2.columns) == ["u", "u_yes"] and out2["u_yes"].tolist() == [1.0, 0.0, 0.0]


def test_dampen_null_minutes_ratio_gives_null(spark):
    df = spark.createDataFrame([(10.0, 20.0, 8.0, 4.0, 2.0), (10.0, None, 8.0, 4.0, 2.0)],
                               "x_exp_mean double, mr double, ml double, x_recent double, x_exp_std double")
    out = P.dampen(df, ["x"], "mr", "ml", recent_fmt="{t}_recent").collect()
    # minutes ratio 20/8 -> clipped 1; target ratio 4/10 = 0.4 -> w = 0.4
    assert out[0].x_exp_mean == pytest.approx(4.0) and out[0].x_exp_std == pytest.approx(2.0 * 1.6)
    assert out[1].x_exp_mean is None


def test_calibration_grid_and_tie_break(spark):
    g = [r.s for r in U.grid_frame(spark).collect()]
    assert g == list(np.linspace(0.3, 3.0, 91))
    # coverage error is identical for every s (all covered), so the smallest s wins
    df = spark.createDataFrame([("t", 1.0, 1.0, 0.1, 0.1)] * 10, "target string, y double, mu double, se double, sa double")
    assert U.fit_std_scale(df, "target", "y", "mu", "se", "sa").first().s == pytest.approx(0.3)


def test_summarize_draws(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=50)
    lv = rng.normal(size=50) * 0.1
    df = spark.createDataFrame([(1, "p", float(a), float(b), float(a)) for a, b in zip(m, lv)],
                               "row int, target string, mean double, logvar double, sample double")
    r = U.summarize_draws(df, ["row", "target"]).first()
    assert r.mean_pred == pytest.approx(m.mean())
    assert r.std_epistemic == pytest.approx(m.std())
    assert r.std_aleatoric == pytest.approx(np.sqrt(np.exp(lv).mean()))
    assert r.q10 == pytest.approx(np.quantile(m, 0.1)) and r.q90 == pytest.approx(np.quantile(m, 0.9))


def test_hash_split_is_deterministic(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = P.hash_split(df, "k").filter("is_cal").count()
    b = P.hash_split(df.repartition(7), "k").filter("is_cal").count()
    assert a == b and 800 < a < 1200


def test_calibration_matches_brute_force_grid(spark):
    """First-covered-index calibration equals evaluating every row at every grid value."""
    rng = np.random.default_rng(4)
    rows = []
    for t in ("a", "b", "c"):
        for _ in range(400):
            q50 = round(float(rng.normal(10, 3)), 2)
            lo, hi = round(q50 - float(rng.uniform(0, 4)), 2), round(q50 + float(rng.uniform(0, 4)), 2)
            y = round(q50 + float(rng.choice([-1, 1])) * float(rng.uniform(0, 6)), 2)
            rows.append((t, y, q50, lo, hi, round(float(rng.uniform(0, 2)), 2), round(float(rng.uniform(0, 3)), 2)))
    rows.append(("a", 1.0, 1.0, 1.0, 1.0, 0.0, 0.0))                 # degenerate row
    df = spark.createDataFrame(rows, "t string, y double, q50 double, lo double, hi double, se double, sa double")
    g = U.grid_frame(spark)
    j = df.crossJoin(F.broadcast(g))

    def brute(inside):
        cov = j.groupBy("t", "s").agg(F.avg(F.coalesce(inside, F.lit(False)).cast("double")).alias("cov"))
        return {r.t: r.s for r in U._pick(cov, "t", 0.8).collect()}

    sd = F.sqrt(F.pow("se", 2) + F.pow(F.col("s") * F.col("sa"), 2))
    z = U.Z80
    std_ref = brute((F.col("y") >= F.col("q50") - z * sd) & (F.col("y") <= F.col("q50") + z * sd))
    q_ref = brute((F.col("y") >= F.col("q50") + F.col("s") * (F.col("lo") - F.col("q50")))
                  & (F.col("y") <= F.col("q50") + F.col("s") * (F.col("hi") - F.col("q50"))))
    got_std = {r.t: r.s for r in U.fit_std_scale(df, "t", "y", "q50", "se", "sa").collect()}
    got_q = {r.t: r.s for r in U.fit_quantile_scale(df, "t", "y", "q50", "lo", "hi").collect()}
    assert got_std == std_ref and got_q == q_ref


def test_one_hot_vector_has_no_limit(spark):
    import tempolith.operators.prep as P
    train = spark.createDataFrame([(f"c{i:05d}",) for i in range(1500)] + [(None,)], "c string")
    df = spark.createDataFrame([("c00003",), ("c01499",), (None,), ("new",)], "c string")
    got = {r.c: tuple(r.c_onehot) for r in P.one_hot_vector(train, df, "c").collect()}
    assert got == {"c00003": (1501, 3, 1.0), "c01499": (1501, 1499, 1.0), None: (1501, 1500, 1.0), "new": (1501, None, 0.0)}


def test_draws_have_noise_and_calibrated_intervals_cover(spark):
    from tempolith.operators import prep as P
    from tempolith.operators import uncertainty as U
    import numpy as np
    r = np.random.default_rng(4)
    rows = [(i, float(x), float(3 * x + 1 + e), 2.0) for i, (x, e) in enumerate(zip(r.normal(size=3000), r.normal(size=3000)))]
    df = spark.createDataFrame(rows, "id long, x double, y double, prior double")
    fitted = U.fit_ensemble(df, "id", ["x"], ["y"], members=20)
    assert all(abs(b[0] - 1) < 0.2 and abs(b[1] - 3) < 0.2 and abs(lv) < 0.2 for _, _, b, lv in fitted)
    s = U.summarize_draws(U.score_draws(df, "id", ["x"], fitted), ["id", "target"]).join(df.select("id", "y"), "id")
    assert s.count() == 3000
    j = P.hash_split(s, "id", 0.5)
    qs = U.fit_quantile_scale(j.filter("is_cal"), "target", "y", "q50", "q10", "q90")
    ev = U.evaluate(U.intervals(j.filter("NOT is_cal"), "target", q_scale=qs, clamp_zero=False), "target", "y", "cal").first()
    assert 0.75 <= ev.pi80_coverage <= 0.85
    blended = U.score_draws(df, "id", ["x"], fitted, priors={"y": "prior"}, own=0.25)
    plain = U.score_draws(df, "id", ["x"], fitted)
    both = blended.select("id", "draw", F.col("mean").alias("b")).join(plain, ["id", "draw"])
    assert both.filter(F.abs(F.col("b") - (0.25 * F.col("mean") + 1.5)) > 1e-9).count() == 0


def test_evaluate_gives_null_where_a_measure_is_undefined(spark):
    from tempolith.operators import uncertainty as U
    df = spark.createDataFrame([("t", 5.0, 4.0, 4.0, 3.0, 6.0, 1.0, 0.5, 0.5)] * 4, "target string, y double, mean_pred double, q50 double, q10 double, q90 double, "
                               "std_predictive double, std_epistemic double, std_aleatoric double")
    got = U.evaluate(df, "target", "y", "x").first()
    assert got.r2 is None and got.uncert_error_corr is None and got.mae_mean == 1.0
