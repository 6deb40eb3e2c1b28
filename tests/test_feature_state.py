"""P4 with saved state: continued builds equal whole ones."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tempolith.plans import feature_state as FS
from tempolith.plans import jobs as J
from tempolith.session import scratch_path


def _frame(spark, drift=0.0):
    r = np.random.default_rng(3)
    rows, n = [], 0
    for user in (*range(8), None):
        for k in range(1 if user == 7 else 120 if user == 2 else int(r.integers(5, 40))):
            v = None if r.random() < 0.25 or (user == 4 and k < 12) else float(r.gamma(2, 10) + drift * k)
            rows.append((n, user, dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(k * 7 + r.integers(0, 5))), v, float(k % 3)))
            n += 1
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, a double, b double").withColumn("d", F.to_date("ts"))


def _same(got, want, cols):
    a, b = (d.select("event_id", "metric", *cols).toPandas().sort_values(["event_id", "metric"]).reset_index(drop=True) for d in (got, want))
    assert len(a) == len(b) and (a.event_id == b.event_id).all()
    for c in cols:
        assert np.allclose(a[c].astype(float), b[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True), c


COLS = [f"x_{c}" for c in ("lag1", "lag2", "exp_mean", "exp_std", "exp_max", "exp_min", "roll_mean", "roll_std", "roll_mad", "roll_trend", "roll_max", "roll_min", "ewm_mean", "ewm_std",
                           "ewm_z", "ewm_above", "ewm_revert", "ewm_dev", "ewm_surges", "delta")]


def test_continued_features_equal_a_whole_build(spark):
    df = _frame(spark)
    whole = J.feature_build_long(df, "user_id", ["ts", "event_id"], "d", ["a", "b"], partitions=5)
    store = FS.FeatureStore(spark, scratch_path(spark, "t_state"), "user_id", ["ts", "event_id"], ["a", "b"], buckets=8)
    kinds = []
    for hours in (30, 31, 200, 10_000):
        done = store.update(df.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours))))
        kinds.append(dict(done.groupBy("rebuilt").count().collect()))
    assert kinds[0] == {True: 9} and kinds[2] == {False: 8} and kinds[3].keys() == {False}
    _same(store.features(), whole, COLS)
    assert store.update(df.repartition(3)).count() == 0


def test_changed_histories_are_rebuilt_and_gone_ones_leave(spark):
    df = _frame(spark)
    store = FS.FeatureStore(spark, scratch_path(spark, "t_state2"), "user_id", ["ts", "event_id"], ["a", "b"], buckets=4)
    wrong = df.filter("NOT (coalesce(user_id, 0) = 1 AND event_id % 3 = 0)").withColumn("a", F.when(F.col("user_id") == 2, F.col("a") + 1).otherwise(F.col("a")))
    gone = df.filter("user_id = 3").withColumn("user_id", F.lit(77).cast("long")).withColumn("event_id", F.col("event_id") + 9000)
    store.update(wrong.unionByName(gone))
    rebuilt = {r.user_id: r.rebuilt for r in store.update(df).collect()}
    assert {u for u, b in rebuilt.items() if b} == {1, 2, 77}
    _same(store.features(), J.feature_build_long(df, "user_id", ["ts", "event_id"], "d", ["a", "b"], partitions=5), COLS)
    assert store.features().filter("user_id = 77").count() == 0


def test_a_drifting_series_keeps_its_digits(spark):
    import pandas as pd
    n = 400
    values = np.arange(n) * 1e9 / n + np.sin(np.arange(n))
    df = spark.createDataFrame([(k, 1, k, float(v)) for k, v in enumerate(values)], "event_id long, user_id long, t long, a double")
    store = FS.FeatureStore(spark, scratch_path(spark, "t_state3"), "user_id", ["t"], ["a"], keep=["event_id"], buckets=2)
    for upto in (150, 151, 400):
        store.update(df.filter(F.col("t") < upto))
    got = store.features().toPandas().sort_values("event_id")
    s = pd.Series(values)
    assert np.allclose(got.x_exp_std.to_numpy(float), s.expanding().std().shift(1), rtol=1e-9, equal_nan=True)
    assert np.allclose(got.x_ewm_mean.to_numpy(float), s.ewm(span=21, adjust=False).mean().shift(1), rtol=1e-9, equal_nan=True)
    assert np.allclose(got.x_ewm_std.to_numpy(float), s.ewm(span=21, adjust=False).std().shift(1), rtol=1e-9, equal_nan=True)


def test_long_layout_on_a_hot_entity_and_date_has_as_many_checkpoints_for_any_number_of_metrics(spark, monkeypatch):
    from tempolith import session
    from tests.test_segmented import _hot_frame
    made = []
    real = session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda df, eager=True: made.append(1) or real(df, eager))
    monkeypatch.setattr(J, "cut_lineage", lambda df, eager=True: made.append(1) or real(df, eager))
    df = _hot_frame(spark).withColumns({f"m{k}": F.col("value") * k for k in range(6)})
    J.feature_build_long(df, "user_id", ["ts", "event_id"], "d", ["value"], season="season", partitions=6)
    one = len(made)
    long = J.feature_build_long(df, "user_id", ["ts", "event_id"], "d", ["value", *[f"m{k}" for k in range(6)]], season="season", partitions=6, rank_bits=20)
    assert len(made) == 2 * one
    wide = J.feature_build(df, "user_id", ["ts", "event_id"], "d", ["value"], season="season", skew_safe_ranks=False, rank_bits=20)
    names = ["exp_mean", "exp_std", "roll_mean", "roll_trend", "ewm_mean", "ewm_std", "ewm_surges", "slope", "delta", "exp_mean_prank", "roll_mean_prank"]
    a = long.filter("metric = 'value'").select("event_id", *[f"x_{c}" for c in names]).toPandas().sort_values("event_id")
    b = wide.select("event_id", *[f"value_{c}" for c in names]).toPandas().sort_values("event_id")
    for c in names:
        assert np.allclose(a[f"x_{c}"].to_numpy(float), b[f"value_{c}"].to_numpy(float), rtol=1e-8, atol=1e-8, equal_nan=True), c
