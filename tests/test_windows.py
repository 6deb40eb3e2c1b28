"""Window features against pandas and hand-computed edge tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tempolith.operators import ewm as E
from tempolith.operators import windows as W


def _frame(spark, rows, cols=("e", "t", "x")):
    df = spark.createDataFrame(pd.DataFrame(rows, columns=list(cols)))
    return df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def _pd(df, key="t"):
    return df.toPandas().sort_values(["e", key]).reset_index(drop=True)


def _exact_ewm_std(xs, alpha_num=2, alpha_den=22):
    """Bias-corrected EWM std with 80-digit decimals (the reference recurrences)."""
    from decimal import Decimal as Q, localcontext
    with localcontext() as ctx:
        ctx.prec = 80
        a = Q(alpha_num) / Q(alpha_den)
        d = 1 - a
        out, m, cov, w2, gap = [], None, Q(0), Q(1), 0
        for x in xs:
            gap += 1
            if not math.isnan(x):
                x = Q(x)
                if m is None:
                    m, cov, w2 = x, Q(0), Q(1)
                else:
                    old = d ** gap
                    A, B = old / (old + a), a / (old + a)
                    m_new = A * m + B * x
                    cov = A * (cov + (m - m_new) ** 2) + B * (x - m_new) ** 2
                    w2 = A * A * w2 + B * B
                    m = m_new
                gap = 0
            out.append(None if m is None or w2 == 1 else math.sqrt(cov / (1 - w2)))
        return out


def test_ewm_matches_pandas_with_gaps_and_long_series(spark):
    rng = np.random.default_rng(1)
    rows = []
    for e, n in [(1, 1), (2, 6), (3, 3000)]:
        x = rng.normal(50, 10, n)
        x[rng.random(n) < 0.2] = np.nan
        if e == 3:
            x[1000:1400] = np.nan            # a long gap
        rows += [(e, i, float(v)) for i, v in enumerate(x)]
    pdf = pd.DataFrame(rows, columns=["e", "t", "x"])
    out = _pd(E.ewm_moments(_frame(spark, rows), "x", ["e"], ["t"], 2 / 22, "m", "s"))
    g = pdf.sort_values(["e", "t"]).groupby("e")["x"]
    ref_m = g.transform(lambda s: s.ewm(span=21, adjust=False).mean()).to_numpy()
    ref_s = g.transform(lambda s: s.ewm(span=21, adjust=False).std()).to_numpy()
    for got, ref in ((out["m"].to_numpy(float), ref_m), (out["s"].to_numpy(float), ref_s)):
        assert (np.isnan(got) == np.isnan(ref)).all()
    got_m, got_s = out["m"].to_numpy(float), out["s"].to_numpy(float)
    ok = ~np.isnan(ref_m)
    assert np.allclose(got_m[ok], ref_m[ok], rtol=1e-9, atol=1e-9)
    # right after a very long gap pandas' 1 - sum(w^2) is ~1e-15 and carries its
    # own rounding error: those rows are checked against exact arithmetic instead
    exact = np.array([np.nan if v is None else v for e in (1, 2, 3)
                      for v in _exact_ewm_std(pdf[pdf.e == e].sort_values("t")["x"].tolist())])
    close_to_pandas = np.isclose(got_s, ref_s, rtol=1e-9, atol=1e-9) | np.isnan(ref_s)
    assert np.allclose(got_s[~close_to_pandas], exact[~close_to_pandas], rtol=1e-9)
    assert (~close_to_pandas).sum() <= 2


def test_ewm_survives_series_longer_than_exp_range(spark):
    # 60k rows: a naive prefix product (1-a)^n underflows after ~7,000 rows
    n = 60000
    df = spark.range(n).select(F.lit(1).alias("e"), F.col("id").alias("t"),
                               (F.sin(F.col("id") / 50.0) * 10 + 100).alias("x"))
    out = E.ewm_moments(df, "x", ["e"], ["t"], 2 / 22, "m", "s").orderBy("t").toPandas()
    ref = pd.Series(np.sin(np.arange(n) / 50.0) * 10 + 100).ewm(span=21, adjust=False)
    assert np.allclose(out["m"], ref.mean(), rtol=1e-9)
    assert np.allclose(out["s"][1:], ref.std()[1:], rtol=1e-6)


def test_rolling_needs_five_values_and_trend_slope(spark):
    rows = [(1, i, v) for i, v in enumerate([1.0, 2.0, np.nan, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0])]
    out = _pd(W.rolling(_frame(spark, rows), ["x"], "e", ["t"], n=5))
    s = pd.Series([1.0, 2.0, np.nan, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]).shift(1)
    r = s.rolling(5)
    assert np.allclose(out["x_roll_mean"].to_numpy(float), r.mean().to_numpy(), equal_nan=True)
    assert np.allclose(out["x_roll_std"].to_numpy(float), r.std().to_numpy(), equal_nan=True)
    # rows 8 (values 4..8) has a full window: slope of an arithmetic run is 1
    assert out.loc[8, "x_roll_trend"] == pytest.approx(1.0)
    assert out.loc[8, "x_roll_mad"] == pytest.approx(1.2)
    assert math.isnan(out.loc[6, "x_roll_trend"])       # window still holds the NULL


def test_expanding_excludes_current_row(spark):
    rows = [(1, 0, 10.0), (1, 1, 20.0), (1, 2, 60.0), (2, 0, 5.0)]
    out = _pd(W.expanding(_frame(spark, rows), ["x"], "e", ["t"]))
    assert out["x_exp_mean"].isna().tolist() == [True, False, False, True]
    assert out.loc[2, "x_exp_mean"] == pytest.approx(15.0)
    assert math.isnan(out.loc[1, "x_exp_std"])           # one prior value: no sample std


def test_percent_rank_average_ties_like_pandas(spark):
    vals = [3.0, 1.0, 3.0, np.nan, 2.0, 3.0]
    rows = [(1, i, v) for i, v in enumerate(vals)]
    out = _pd(W.pct_rank_within(_frame(spark, rows), "e", ["x"]))
    ref = pd.Series(vals).rank(pct=True)
    assert np.allclose(out["x_prank"].to_numpy(float), ref.to_numpy(), equal_nan=True)


def test_streak_counts_run_ending_before_row(spark):
    flags = [1, 1, 0, 1, 1, 1, 0]
    df = spark.createDataFrame([(1, i, f) for i, f in enumerate(flags)], ["e", "t", "hot"])
    out = W.streak_before(df, "hot", "e", ["t"], "streak").orderBy("t").toPandas()
    s = pd.Series(flags).shift(1)
    ref = s.groupby((s != 1).cumsum()).cumcount()
    assert out["streak"].tolist() == ref.tolist()


def test_trend_slope_guards(spark):
    rows = [(1, i, 5.0) for i in range(30)] + [(2, i, float(i % 7)) for i in range(30)]
    out = W.trend_slope(spark.createDataFrame(rows, ["e", "t", "x"]), ["x"], "e", ["t"], min_rows=21)
    got = out.orderBy("e", "t").toPandas()
    assert got[got.e == 1]["x_slope"].isna().all()        # constant series
    g2 = got[got.e == 2].reset_index(drop=True)
    assert g2.loc[:19, "x_slope"].isna().all() and g2.loc[20:, "x_slope"].notna().all()
    y = pd.Series([float(i % 7) for i in range(30)]).shift(1)[:25]
    xs = np.arange(25)[1:]
    assert g2.loc[24, "x_slope"] == pytest.approx(np.polyfit(xs, y[1:], 1)[0])


def test_count_last_days_counts_distinct_dates(spark):
    import datetime as dt
    d = [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 3), dt.date(2024, 1, 8), dt.date(2024, 1, 9)]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(d)], ["e", "t", "d"])
    out = W.count_last_days(df, "e", "d", days=7).orderBy("t").toPandas()
    assert out["n_last_days"].tolist() == [1, 1, 2, 2, 3]


def test_features_do_not_leak_future_rows(spark):
    """Changing rows at or after t never changes a feature at t."""
    rng = np.random.default_rng(3)
    base = [(1, i, float(v)) for i, v in enumerate(rng.normal(10, 2, 40))]
    cut = 25
    altered = base[:cut] + [(1, i, v * 100 + 7) for (_, i, v) in base[cut:]]

    def feats(rows):
        df = _frame(spark, rows)
        df = W.expanding(W.rolling(df, ["x"], "e", ["t"]), ["x"], "e", ["t"])
        df = E.ewm(df, ["x"], "e", ["t"])
        cols = ["x_exp_mean", "x_exp_std", "x_roll_mean", "x_roll_trend", "x_ewm_mean", "x_ewm_std"]
        return df.orderBy("t").toPandas()[cols].iloc[: cut + 1]

    a, b = feats(base), feats(altered)
    assert np.allclose(a.to_numpy(float), b.to_numpy(float), equal_nan=True)


def test_allowed_dedupes_event_level_stats(spark):
    import datetime as dt
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    # team score 100 repeated on three member rows of event 1, 80 on two rows of event 2
    rows = [("opp", d1, 1, 100.0)] * 3 + [("opp", d2, 2, 80.0)] * 2
    df = spark.createDataFrame(rows, "opp string, d date, ev int, score double")
    plain = {r.d: r.allowed_score_ewm for r in E.allowed(df, ["opp"], "d", ["score"]).collect()}
    dedup = {r.d: r.allowed_score_ewm for r in E.allowed(df, ["opp"], "d", ["score"], dedupe_by="ev").collect()}
    assert plain[d2] == pytest.approx(300.0) and dedup[d2] == pytest.approx(100.0)
