"""Fitted preprocessing and scoring: what is saved scores as what was fitted."""

import numpy as np
from pyspark.sql import functions as F

from tempolith.operators.preprocess import Preprocessor
from tempolith.plans import jobs as J
from tempolith.session import scratch_path


def rows(spark, n=2000, seed=3):
    r = np.random.default_rng(seed)
    x, z = r.normal(size=n), r.normal(size=n)
    data = [(i, float(a), None if i % 11 == 0 else float(b), "abc"[i % 3], "yes" if i % 2 else "no", float(2 * a - b + r.normal())) for i, (a, b) in enumerate(zip(x, z))]
    return spark.createDataFrame(data, "id long, x double, z double, cat string, flag string, y double")


def test_saved_preprocessing_equals_the_fitted_one(spark):
    df = rows(spark)
    train = df.filter("id < 1500").withColumn("prior", F.when(F.col("id") % 4 != 0, F.col("y")))
    fitted = Preprocessor.fit(train, numeric=["x", "z"], categorical=["cat", "flag"], index=["cat"], priors=["prior"], variance=1.0)
    assert fitted.components == 2 and [c for c in fitted.features if c.startswith("flag")] == ["flag_yes"]
    path = scratch_path(spark, "pre")
    fitted.save(spark, path)
    loaded = Preprocessor.load(spark, path)
    new = spark.createDataFrame([(1, 0.5, None, "new", None, None), (2, None, 1.0, "a", "yes", 2.0)], "id long, x double, z double, cat string, flag string, prior double")
    a, b = (p.transform(new).orderBy("id").collect() for p in (fitted, loaded))
    assert a == b and loaded.features == fitted.features
    assert a[0]["cat_idx"] == 0 and a[1]["cat_idx"] == 1 and (a[0]["cat_a"], a[1]["cat_a"], a[0]["flag_yes"]) == (0.0, 1.0, 0.0)
    # more categories than may have a column each: one sparse vector
    assert Preprocessor.fit(train, categorical=["cat"], max_categories=2).sparse.keys() == {"cat"}


def test_scoring_with_saved_artifacts_covers(spark):
    df = rows(spark, 3000)
    path = scratch_path(spark, "artifacts")
    J.fit_artifacts(df.filter("id < 2000"), "id", ["y"], path, members=20, numeric=["x", "z"], categorical=["cat"], variance=1.0)
    new = df.filter("id >= 2000")
    out = J.score_slate(new.drop("y"), "id", path, ["y"], ["mean_pred", "q10", "q90", "std80_lower", "std80_upper"], clamp_zero=False).join(new.select("id", "y"), "id")
    got = out.agg(F.count(F.lit(1)), F.avg((F.col("y").between(F.col("y_q10"), F.col("y_q90"))).cast("double")),
                  F.avg((F.col("y").between(F.col("y_std80_lower"), F.col("y_std80_upper"))).cast("double")), F.corr("y", "y_mean_pred")).first()
    assert got[0] == 1000 and 0.74 <= got[1] <= 0.86 and 0.74 <= got[2] <= 0.86 and got[3] > 0.85


def test_many_categories_become_one_sparse_vector(spark, tmp_path):
    from pyspark.sql import functions as F
    from tempolith.operators.preprocess import Preprocessor
    train = spark.range(8000).select(F.concat(F.lit("c"), (F.col("id") % 1500).cast("string")).alias("c"), (F.col("id") % 3).cast("string").alias("few"), F.col("id").cast("double").alias("v"))
    train = train.unionByName(spark.createDataFrame([("rare", None, 1.0), (None, "0", None)], "c string, few string, v double"))
    pre = Preprocessor.fit(train, numeric=["v"], categorical=["few", "c"])
    pre.save(spark, str(tmp_path / "p"))
    again = Preprocessor.load(spark, str(tmp_path / "p"))
    assert pre.sparse == again.sparse == {"c": 1502} and len(pre.features) == 5       # 1 / 8002 still varies by more than 1e-4
    assert Preprocessor.fit(train, categorical=["c"], least_variance=2e-4).sparse == {"c": 1500}
    df = spark.createDataFrame([("c7", "1", 5.0), ("new", "9", None), (None, None, 1.0)], "c string, few string, v double")
    rows = {r.c: r.features for r in again.assembled(df).collect()}
    order = sorted(["missing", "rare", *[f"c{k}" for k in range(1500)]])
    assert rows["c7"].size == 1507 and rows["c7"].indices == [0, 1, 2, 3, 4, 5 + order.index("c7")] and rows["c7"]["values"][1:] == [0.0, 1.0, 0.0, 0.0, 1.0]
    assert rows["new"].indices == [0, 1, 2, 3, 4] and rows[None].indices[-1] == 5 + order.index("missing")
