"""Whitening of embeddings by a matrix-free block Jacobi-Davidson solver.

The covariance V of the vectors is never formed. Spark multiplies it with a few directions at a time, in one pass: each
task adds up C'(C B) over its rows, C being the centred rows, and the sums of tasks are added in a second, smaller
stage, so what reaches the driver is about the square root of the number of tasks times a matrix of dimension times
directions. The driver holds only such thin matrices (bounded by the dimension, never by the rows) and runs the
method on them:

* a Rayleigh-Ritz step in the search space gives the leading approximate components and their residuals;
* components whose residual has reached double precision are locked, largest first, and projected out;
* for each of the others the correction equation (I - ZZ')(V - theta I)(I - ZZ') t = -r, Z being all locked and
  current components, is solved by a few MINRES steps, those of all components sharing each distributed product;
* the corrections widen the search space, which is restarted from its best vectors when it is full.

Entries are read as integers x = floor(1024 c) + 100000, so sums and deviations are exact; x - S/n is formed as
(x - S div n) - (S mod n) / n, which keeps all of a double's digits.

Rows without a vector, with an empty vector or with a null or non-finite entry are left out; so are vectors whose
length is not the commonest one (of equally common lengths the longest). Entries beyond 9e12 count as that. A
component of no variance (fewer rows than dimensions, repeated rows only) has whitened and explained 0 and is not part
of the identity error. With fewer dimensions than components asked for, there are that many. A deviation that no
64-bit integer holds is null. Repeated rows and null ids are rows like others; an empty table gives an empty result.
Columns other than the id and the vector are not read. Equal eigenvalues have any orthonormal vectors as components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, table
from tempolith.llm.registry import query

SCALE, SHIFT, WIDEST = 1024.0, 100000, 9e12
#: Rows that a task turns into doubles at a time.
ROWS = 4096
#: MINRES steps for a correction, and the share of its right side at which it stops.
INNER, SOLVED = 8, 0.01
#: Directions that a start has beyond those asked for, and vectors of a full search space for each one asked for.
SPARE, WIDTH = 4, 8


class Fit(NamedTuple):
    """n rows, exact sums, trace of V, eigenvalues by falling size, unit eigenvectors (columns), residual norms, products used."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


# ---------------------------------------------------------------- rows as matrices
def _matrices(batches: Iterable[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for at in range(0, len(flat), ROWS):
            yield flat[at:at + ROWS]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _sum_tasks(df: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], np.ndarray], tasks: int) -> np.ndarray:
    """Sum of the arrays that ``each`` makes of a task's rows: by task, then by groups of tasks, then here."""
    def of_task(batches):
        import pyspark

        part = pyspark.TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "total": pa.array([each(batches).tobytes()], pa.binary())})

    def of_group(batches):
        rows = sorted((p, t) for b in batches for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        if rows:
            total = sum(np.frombuffer(t) for _, t in rows)
            yield pa.RecordBatch.from_pydict({"part": pa.array([rows[0][0]], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    kind = "part int, total binary"
    sums = df.mapInArrow(of_task, kind).repartition(math.isqrt(max(tasks - 1, 0)) + 1).mapInArrow(of_group, kind)
    return sum(np.frombuffer(r.total) for r in sorted(sums.collect(), key=lambda r: r.part))


def _exact_sums(df: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and sums by dimension, in two halves of 31 bits so that no partial sum overflows."""
    def halves(batches):
        high, low, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for x in _matrices(batches, d):
            high, low, n = high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0), n + len(x)
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(d + 1), pa.int32()), "high": pa.array([*high.tolist(), n]),
                                          "low": pa.array([*low.tolist(), 0])})

    got = df.mapInArrow(halves, "k int, high long, low long").groupBy("k").agg(
        *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).collect()
    by = {r.k: (int(r.high), int(r.low)) for r in got}
    return by.get(d, (0, 0))[0], [(by[k][0] << 31) + by[k][1] for k in range(d)] if by else []


# ---------------------------------------------------------------- the solver, on thin matrices
def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """What ``new`` adds to orthonormal columns, as orthonormal columns; directions that add nothing go."""
    kept: list[np.ndarray] = []
    base = np.hstack([a for a in against]) if against else np.zeros((len(new), 0))
    for v in new.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            v = v - base @ (base.T @ v)
            for u in kept:
                v = v - u * (u @ v)
            left = np.linalg.norm(v)
            if left < 1e-8:
                break
            v = v / left
        else:
            kept.append(v)
    return np.array(kept).T if kept else np.zeros((len(new), 0))


def _minres(product: Callable, shift: np.ndarray, known: np.ndarray, right: np.ndarray) -> np.ndarray:
    """MINRES for all columns side by side: (I - ZZ')(V - shift I)(I - ZZ') t = right, from t = 0."""
    def off(m):
        return m - known @ (known.T @ m)

    right = off(right)
    beta = np.linalg.norm(right, axis=0)
    goal, live = SOLVED * beta, beta > 0
    safe = lambda a: np.where(a > 0, a, 1.0)
    v, old = right / safe(beta), np.zeros_like(right)
    step, step_old, t = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c = c_old = np.ones(len(beta))
    s = s_old = np.zeros(len(beta))
    left, last = beta.copy(), np.zeros(len(beta))
    for _ in range(INNER):
        if not live.any():
            break
        p = off(product(v) - shift * v) - last * old
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v
        beta = np.linalg.norm(p, axis=0)
        r0 = c * alpha - c_old * s * last
        r1, r2, r3 = np.hypot(r0, beta), s * alpha + c_old * c * last, s_old * last
        live &= r1 > 0
        c_old, s_old, c, s = c, s, r0 / safe(r1), beta / safe(r1)
        step_old, step = step, (v - r3 * step_old - r2 * step) / safe(r1)
        t = t + np.where(live, c * left, 0.0) * step
        left = -s * left
        live &= (np.abs(left) > goal) & (beta > 0)
        old, v, last = v, p / safe(beta), beta
    return off(t)


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric non-negative operator, their vectors and residual norms.

    All residuals reach double precision: 1e-14 of the largest eigenvalue times the root of the dimension. If rounding
    in the products leaves them above that, the solver ends when three rounds no longer halve one below 1e-11.
    """
    wanted = min(wanted, d)
    space = _orthonormal(np.random.default_rng(12).standard_normal((d, min(d, wanted + SPARE))))
    image = product(space)
    locked, locked_image, values = np.zeros((d, 0)), np.zeros((d, 0)), []
    best, idle = np.inf, 0
    while True:
        h = space.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        space, image = space @ s, image @ s
        most = max([0.0, *values, theta[0] if len(theta) else 0.0])
        need = min(wanted - locked.shape[1], space.shape[1])
        rest = image[:, :need] - space[:, :need] * theta[:need]
        rest = rest - locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        first = size[0] / most if need and most > 0 else 0.0
        best, idle = (first, 0) if first < best / 2 else (best, idle + 1)
        enough = 1e-14 * math.sqrt(d) * most
        if idle >= 3 and first <= 1e-11:
            enough = max(enough, size[0])
        done = 0
        while done < need and size[done] <= enough:
            done += 1
        if done:
            locked, locked_image = np.hstack([locked, space[:, :done]]), np.hstack([locked_image, image[:, :done]])
            values += list(theta[:done])
            space, image, best, idle = space[:, done:], image[:, done:], np.inf, 0
        if locked.shape[1] >= wanted:
            break
        now = need - done
        if space.shape[1] + locked.shape[1] < d:
            known = np.hstack([locked, space[:, :now]])
            turn = _minres(product, theta[done:need], known, -rest[:, done:])
            if space.shape[1] > WIDTH * wanted:
                keep = 2 * wanted + SPARE
                space, image = space[:, :keep], image[:, :keep]
            add = _orthonormal(np.hstack([turn, rest[:, done:]]) if not np.any(turn) else turn, locked, space)
            if not add.shape[1]:  # nothing new: go on from a direction outside the space
                add = _orthonormal(np.random.default_rng(space.shape[1]).standard_normal((d, 2)), locked, space)
            space, image = np.hstack([space, add]), np.hstack([image, product(add)])
        elif not done:  # the space is everything; its products are taken afresh
            space = _orthonormal(space, locked)
            image = product(space)
    h = locked.T @ locked_image
    theta, s = np.linalg.eigh((h + h.T) / 2)
    vectors, image = locked @ s[:, ::-1], locked_image @ s[:, ::-1]
    values = np.maximum(theta[::-1], 0.0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])])
    image = image * np.sign((vectors * image).sum(axis=0) + 0.0) if values.any() else image
    return values, vectors, np.linalg.norm(image - vectors * values, axis=0)


# ---------------------------------------------------------------- operator
def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows whose vector has entries, none of them null or non-finite; x as 64-bit integers."""
    c = F.col(vector_col).cast("array<double>")
    sound = (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(c, lambda e: F.least(F.greatest(F.floor(F.least(F.greatest(e, F.lit(-WIDEST)), F.lit(WIDEST)) * SCALE),
                                                        F.lit(-2**62)), F.lit(2**62)).cast("long") + SHIFT)
    return vectors.select(F.col(id_col), F.when(c.isNotNull() & sound, whole).alias("x")).filter("x IS NOT NULL")


def _dimension(rows: DataFrame) -> int:
    top = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top.d if top else 0


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 8) -> Fit | None:
    """Leading components of the covariance of all vectors; None if there is none."""
    spark, stage = vectors.sparkSession, Scratch(vectors.sparkSession, "whitening")
    held = stage.keep(integer_vectors(vectors.select(vector_col, F.lit(0).alias("__id")), "__id", vector_col).select("x"), "vectors")
    d = _dimension(held)
    if not d:
        stage.drop()
        return None
    held = held.filter(F.size("x") == d)
    n, sums = _exact_sums(held, d)
    tasks = held.rdd.getNumPartitions()
    trace, used = [0.0], 0

    def product(b: np.ndarray) -> np.ndarray:
        nonlocal used
        used += 1
        held_b = np.ascontiguousarray(b)

        def each(batches):
            total = np.zeros(held_b.size + 1)
            for x in _matrices(batches, d):
                c = _centred(x, n, sums)
                total[:-1] += (c.T @ (c @ held_b)).ravel()
                total[-1] += np.einsum("ij,ij->", c, c)
            return total

        total = _sum_tasks(held, each, tasks)
        trace[0] = total[-1] / n
        return total[:-1].reshape(held_b.shape) / n

    values, found, residuals = jacobi_davidson(product, d, components)
    stage.drop()
    return Fit(n, sums, trace[0], values, found, residuals, used)


_OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projector(model: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Columns that project and scale, and which components have variance."""
    real = model.values > 1e-13 * max(model.trace, 0.0)
    return model.vectors * np.where(real, 1 / np.sqrt(np.where(real, model.values, 1.0)), 0.0), real


def whitened(vectors: DataFrame, model: Fit, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, z): each remaining row's whitened coordinates as one array."""
    d, project = len(model.sums), _projector(model)[0]

    def each(batches):
        for batch in batches:
            rows = [_centred(x, model.n, model.sums) @ project for x in _matrices([batch], d)]
            z = np.vstack(rows) if rows else np.zeros((0, project.shape[1]))
            at = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(z.ravel()))], names=[id_col, "z"])

    rows = integer_vectors(vectors, id_col, vector_col).filter(F.size("x") == d)
    return rows.mapInArrow(each, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, z array<double>")


def identity_error(vectors: DataFrame, model: Fit, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components with variance."""
    d, (project, real) = len(model.sums), _projector(model)
    if not real.any():
        return 0.0
    project, k = project[:, real], int(real.sum())
    rows = integer_vectors(vectors.select(vector_col, F.lit(0).alias("__id")), "__id", vector_col).select("x").filter(F.size("x") == d)
    tasks = rows.rdd.getNumPartitions()

    def total(mean: np.ndarray, power: int) -> np.ndarray:
        def each(batches):
            out = np.zeros(k if power == 1 else k * k)
            for x in _matrices(batches, d):
                z = _centred(x, model.n, model.sums) @ project - mean
                out += z.sum(axis=0) if power == 1 else (z.T @ z).ravel()
            return out
        return _sum_tasks(rows, each, tasks) / model.n

    mean = total(np.zeros(k), 1)
    return float(np.abs(total(mean, 2).reshape(k, k) - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """Per remaining row and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {_OUT}"
    model = fit(vectors, vector_col, components)
    if model is None:
        return spark.createDataFrame([], schema)
    d, n, (project, real) = len(model.sums), model.n, _projector(model)
    error = identity_error(vectors, model, vector_col)
    explained = np.where(real, model.values / (model.trace or 1.0), 0.0)
    k = len(explained)
    sums = np.array(model.sums, object)

    def deviations(x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, in 64 bits where that is sure to be exact."""
        far = int(np.abs(x).max(initial=0)) * n + max(abs(s) for s in model.sums)
        if far * far * d < 2**63:
            away = x * n - np.array(model.sums, np.int64)
            return (away * away).sum(axis=1).tolist()
        exact = [(sum((int(v) * n - s) ** 2 for v, s in zip(row, sums))) for row in x]
        return [v if v < 2**63 else None for v in exact]

    def each(batches):
        for batch in batches:
            ids, at = batch.column(0), 0
            for x in _matrices([batch], d):
                z, m = _centred(x, n, model.sums) @ project, len(x)
                own = ids.slice(at, m).take(pa.array(np.repeat(np.arange(m), k)))
                far = pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)), far,
                     pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
                at += m

    rows = integer_vectors(vectors, id_col, vector_col).filter(F.size("x") == d)
    return rows.mapInArrow(each, schema)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
