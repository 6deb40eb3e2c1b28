"""Long layout (metrics unpivoted) gives the same features as the wide build."""

import numpy as np
from pyspark.sql import functions as F

from tempolith.operators import ewm as EW
from tempolith.operators import windows as W
from tempolith.plans import jobs as J


def test_long_layout_equals_wide(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(u), int(t), float(rng.normal(10, 3)), float(rng.normal(0, 1)))
            for i, (u, t) in enumerate((u, t) for u in range(6) for t in range(30))]
    df = spark.createDataFrame(rows, "event_id long, user_id long, t long, a double, b double") \
        .withColumn("d", (F.col("t") / 3).cast("int"))
    order = ["t", "event_id"]
    long = J.feature_build_long(df, "user_id", order, "d", ["a", "b"], slope_min_rows=10)
    feats = ["x_lag1", "x_exp_mean", "x_roll_trend", "x_ewm_mean", "x_ewm_std", "x_slope", "x_exp_mean_prank"]
    wide = J.to_wide(long, ["event_id"], ["a", "b"], feats).toPandas().sort_values("event_id").reset_index(drop=True)
    ref = W.lags(df, ["a", "b"], "user_id", order)
    ref = W.expanding(ref, ["a", "b"], "user_id", order)
    ref = W.rolling(ref, ["a", "b"], "user_id", order)
    ref = EW.ewm(ref, ["a", "b"], "user_id", order)
    ref = W.trend_slope(ref, ["a", "b"], "user_id", order, min_rows=10)
    ref = W.pct_rank_within(ref, "d", ["a_exp_mean", "b_exp_mean"])
    ref = ref.toPandas().sort_values("event_id").reset_index(drop=True)
    for m in ("a", "b"):
        for f in ("lag1", "exp_mean", "roll_trend", "ewm_mean", "ewm_std", "slope", "exp_mean_prank"):
            x, y = wide[f"{m}_{f}"].to_numpy(float), ref[f"{m}_{f}"].to_numpy(float)
            assert (np.isnan(x) == np.isnan(y)).all(), (m, f)
            assert np.allclose(x[~np.isnan(x)], y[~np.isnan(y)], rtol=1e-12, atol=1e-12), (m, f)


def test_to_wide_single_feature_names(spark):
    long = spark.createDataFrame([(1, "a", 1.5), (1, "b", 2.5), (2, "a", 3.5)], "id int, metric string, x_lag1 double")
    wide = J.to_wide(long, ["id"], ["a", "b"], ["x_lag1"]).orderBy("id").collect()
    assert [tuple(r) for r in wide] == [(1, 1.5, 2.5), (2, 3.5, None)]
    assert J.to_wide(long, ["id"], ["a", "b"], ["x_lag1"]).columns == ["id", "a_lag1", "b_lag1"]


def test_long_layout_refuses_what_it_cannot_give(spark):
    import pytest
    from tempolith.plans import jobs as J
    df = spark.createDataFrame([(1, 1, 1, 1.0)], "u int, o int, d int, x double")
    with pytest.raises(ValueError, match="context"):
        J.feature_build(df, "u", ["o"], "d", ["x"], layout="long", context="d", context_values=(1,))
