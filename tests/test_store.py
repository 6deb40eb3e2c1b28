"""Group stores: what a digest notices, what an update touches."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from tempolith.plans import jobs as J
from tempolith.session import scratch_path
from tempolith.sources import store as ST


def _digest(spark, rows):
    df = spark.createDataFrame(rows, "g int, a string, b int")
    return {r.g: (r.rows, r.digest_a, r.digest_b) for r in ST.digest(df, "g").collect()}


def test_digest_is_a_multiset_with_nulls(spark):
    base = _digest(spark, [(1, "x", 1), (1, "x", 1), (1, "q", 2)])
    assert base == _digest(spark, [(1, "q", 2), (1, "x", 1), (1, "x", 1)])
    others = [[(1, "y", 1), (1, "y", 1), (1, "q", 2)], [(1, "x", 1), (1, "q", 2)], [(1, "x", None), (1, "x", 1), (1, "q", 2)], [(1, "x", 1), (1, "q", 2), (1, "q", 2)],
              [(1, None, 1), (1, "x", 1), (1, "q", 2)]]
    seen = [base[1], *(_digest(spark, o)[1] for o in others)]
    assert len(set(seen)) == len(seen)
    assert _digest(spark, [(1, None, 1)]) != _digest(spark, [(1, "1", None)])
    assert None in _digest(spark, [(None, "x", 1)])


def _files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def test_only_touched_buckets_are_written(spark):
    path = scratch_path(spark, "t_store").removeprefix("file:")
    store = ST.GroupStore(spark, path, "g", buckets=64)
    base = spark.range(200).select((F.col("id") % 20).alias("g"), "id", F.lit(1).alias("v"))
    build = lambda p: {"sums": p["base"].groupBy("g").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))}
    assert store.update({"base": base}, build).count() == 20
    before = _files(f"{path}/sums")
    assert store.update({"base": base.repartition(7)}, build).count() == 0 and _files(f"{path}/sums") == before
    later = base.withColumn("v", F.when((F.col("g") == 3) & (F.col("id") == 23), 5).otherwise(F.col("v"))).filter("g <> 7")
    later = later.unionByName(spark.createDataFrame([(None, 900, 2)], "g long, id long, v int"))
    assert sorted((r.g for r in store.update({"base": later}, build).collect()), key=str) == [3, 7, None]
    assert {r.g: (r.s, r.n) for r in store.table("sums").collect()} == {g: (14 if g == 3 else 10, 10) for g in range(20) if g != 7} | {None: (2, 1)}
    bucket = {r.g: r.b for r in spark.createDataFrame([(g,) for g in [*range(20), None]], "g long").select("g", F.pmod(F.xxhash64("g"), F.lit(64)).alias("b")).collect()}
    touched = {bucket[3], bucket[7], bucket[None]}
    after = _files(f"{path}/sums")
    kept = {p: t for p, t in before.items() if int(p.split("bucket=")[1].split(os.sep)[0]) not in touched}
    assert kept and all(after.get(p) == t for p, t in kept.items())
    assert len(list(Path(f"{path}/manifest").glob("version=*"))) == 2


def test_a_broken_update_is_repeated(spark):
    store = ST.GroupStore(spark, scratch_path(spark, "t_store2"), ["g", "h"], buckets=4)
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "g int, h string, v int")

    def broken(part):
        raise RuntimeError("lost")

    build = lambda p: {"t": p["base"].groupBy("g", "h").agg(F.sum("v").alias("s")), "u": p["base"]}
    store.update({"base": base}, build)
    changed = base.withColumn("v", F.col("g"))
    try:
        store.update({"base": changed}, broken)
    except RuntimeError:
        pass
    assert [(r.g, r.h) for r in store.update({"base": changed}, build).collect()] == [(2, "b")]
    assert sorted((r.g, r.s) for r in store.table("t").collect()) == [(1, 1), (2, 2)]
    assert store.update({"base": changed.limit(0)}, build).count() == 2 and store.update({"base": changed.limit(0)}, build).count() == 0


def test_team_intervals_are_rebuilt_by_event(spark):
    """A change of one team's log moves the other's boundaries; excluded events and short intervals stay out."""
    store = ST.GroupStore(spark, scratch_path(spark, "t_store3"), "event", buckets=8)
    starters = spark.createDataFrame([(e, t, m) for e in (1, 2, 3) for t, m in (("a", 10), ("b", 20))], "event int, team string, member long")
    spans = spark.createDataFrame([(e, t, 0, 100) for e in (1, 2, 3) for t in "ab"], "event int, team string, start int, end int")
    log = [(1, "a", 10, 40, False), (1, "a", 11, 40, True), (2, "b", 20, 95, False), (2, "b", 21, 95, True)]
    schema = "event int, team string, member long, clk int, is_in boolean"
    shots = spark.createDataFrame([(e, t, c) for e in (1, 2, 3) for t in "ab" for c in (20, 60, 97)], "event int, team string, clk int")
    run = lambda rows: J.update_interval_store(store, spark.createDataFrame(rows, schema), starters, spans, shots, "member", "clk", "is_in", 1,
                                               {"n": F.count(F.lit(1))}, 50.0, group=["event", "team"], event="event", min_duration=10, exclude={"event": [3]})
    assert run(log).count() == 3
    got = lambda: sorted((r.event, r.team, r.start, r.end, r.lineup, r.n) for r in store.table("intervals").collect())
    one = [(1, "a", 0, 40, "10", 1), (1, "a", 40, 100, "11", 2), (1, "b", 0, 40, "20", 1), (1, "b", 40, 100, "20", 2)]
    assert got() == one + [(2, "a", 0, 95, "10", 2), (2, "b", 0, 95, "20", 2)]
    assert [r.event for r in run(log[:2] + [(2, "b", 20, 50, False), (2, "b", 21, 50, True)]).collect()] == [2]
    assert got() == one + [(2, "a", 0, 50, "10", 1), (2, "a", 50, 100, "10", 2), (2, "b", 0, 50, "20", 1), (2, "b", 50, 100, "21", 2)]
