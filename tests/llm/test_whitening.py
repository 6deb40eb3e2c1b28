import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempolith.llm.whitening import fit, jacobi_davidson, whiten, whitened
from tests.llm.helpers import CLASH

SCHEMA = "vec_id long, embedding array<float>"


def _frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(v) if v is not None else F.lit(None).cast("int") for c, v in (CLASH | {"x": 1, "k": 2, "part": 0, "z": "z"}).items()}) if clash else df


def _plain(rows):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    c = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    return kept, far, c, c.T @ c / n


def _close(got, rows, components=8):
    kept, far, c, v = _plain(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    want = c @ vectors / np.sqrt(values)
    assert len(got) == len(kept) * len(values)
    by = {(r.vec_id, r.component): r for r in got}
    table = np.array([[by[i, k + 1].whitened for k in range(len(values))] for i, _ in kept])
    sign = np.sign((table * want).sum(axis=0))
    assert np.abs(table - want * sign).max() < 1e-8
    for (i, _), d in zip(kept, far):
        r = by[i, 1]
        assert r.deviation == d and r.n == len(kept) and r.identity_error < 1e-10
    for k, e in enumerate(values):
        assert by[kept[0][0], k + 1].explained == pytest.approx(e / np.trace(v), rel=1e-10)


def test_whitening_against_dense(spark):
    r = np.random.default_rng(3)
    mix = r.standard_normal((20, 20)) * np.geomspace(1, 0.05, 20)[:, None]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(r.standard_normal((700, 20)) @ mix)]
    rows += [(1000, None), (1001, [float("nan")] * 20), (1002, [None] + [0.0] * 19), (1003, [float("inf")] * 20), (1004, []), (1005, [1.0, 2.0])]
    got = whiten(_frame(spark, rows, clash=True).repartition(5)).collect()
    _close(got, rows[:700])
    model = fit(_frame(spark, rows))
    assert model.residuals.max() <= 1e-13 * model.values[0] and model.n == 700
    z = whitened(_frame(spark, rows), model).filter("vec_id = 5").first().z
    assert z == pytest.approx([x.whitened for x in sorted((x for x in got if x.vec_id == 5), key=lambda x: x.component)], abs=1e-9)


def test_few_dimensions_repeated_rows_and_no_variance(spark):
    r = np.random.default_rng(4)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(r.standard_normal((40, 3)))]
    _close(whiten(_frame(spark, rows)).collect(), rows)
    same = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]
    got = whiten(_frame(spark, same)).collect()
    assert len(got) == 6 and {(x.whitened, x.explained, x.deviation, x.identity_error) for x in got} == {(0.0, 0.0, 0, 0.0)}
    line = [(k, [float(k), 2.0 * k, 0.0]) for k in range(9)]
    got = whiten(_frame(spark, line)).collect()
    assert {x.whitened for x in got if x.component > 1} == {0.0} and all(x.identity_error < 1e-9 for x in got)
    assert sum(x.whitened ** 2 for x in got if x.component == 1) / 9 == pytest.approx(1)


def test_empty_and_extreme(spark):
    assert whiten(_frame(spark, [])).collect() == [] == whiten(_frame(spark, [(1, None)])).collect()
    got = whiten(_frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])])).collect()
    assert len(got) == 6 and all(math.isfinite(x.whitened) for x in got) and {x.deviation for x in got if x.vec_id == 1} == {None}


@pytest.mark.parametrize("shape,scale", [((3000, 64), 1.0), ((200, 150), 1.0), ((500, 40), 1e4)])
def test_solver_reaches_double_precision(shape, scale):
    c = np.random.default_rng(5).standard_normal(shape) * np.geomspace(1, scale, shape[1])
    values, vectors, left = jacobi_davidson(lambda b: c.T @ (c @ b) / len(c), shape[1], 8)
    want = np.linalg.eigvalsh(c.T @ c / len(c))[::-1][:8]
    assert np.allclose(values, want, rtol=1e-12) and left.max() <= 1e-12 * want[0]
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)


def test_solver_with_equal_eigenvalues():
    values, vectors, left = jacobi_davidson(lambda b: np.array([4.0] * 10 + [1.0] * 30)[:, None] * b, 40, 8)
    assert np.allclose(values, 4) and left.max() < 1e-12 and np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)
