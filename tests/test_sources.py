"""Sources, sinks, JSON documents and incremental streaming ingest."""

import datetime as dt
import json

from pyspark.sql import types as T

from tempolith.session import scratch_path
from tempolith.sources import io as IO
from tempolith.sources import json as J
from tempolith.streaming.ingest import ingest_new_files


def test_csv_with_missing_optional_column(spark):
    path = scratch_path(spark, "t_csv")
    spark.createDataFrame([(1, "a"), (2, None)], "id long, name string") \
        .write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    rows = sorted(IO.load_csv(spark, path, schema).collect())
    assert [tuple(r) for r in rows] == [(1, "a", None), (2, None, None)]


def test_dynamic_partition_overwrite_replaces_only_written_partitions(spark):
    path = scratch_path(spark, "t_parts")
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2021)], "id long, season int")
    IO.append_partition(df, path, "season")
    IO.append_partition(spark.createDataFrame([(9, 2021)], "id long, season int"), path, "season")
    got = sorted((r.id, r.season) for r in spark.read.parquet(path).collect())
    assert got == [(1, 2020), (9, 2021)]


def test_dated_sink_rerun_same_day(spark):
    path = scratch_path(spark, "t_dated")
    IO.save_dated(spark.createDataFrame([(1,)], "x int"), path, dt.date(2024, 1, 1))
    IO.save_dated(spark.createDataFrame([(2,)], "x int"), path, dt.date(2024, 1, 2))
    IO.save_dated(spark.createDataFrame([(3,)], "x int"), path, dt.date(2024, 1, 2))
    got = sorted((str(r.run_date), r.x) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_detect_changes_reasons(spark):
    src = spark.createDataFrame([(1, 5), (1, 9), (2, 3), (2, 4), (3, 1)], "id int, d int")
    out = spark.createDataFrame([(1, 5), (2, 3), (2, 4), (4, 1)], "id int, d int")
    got = {r.id: r.reason for r in IO.detect_changes(src, out, "id", "d").collect()}
    assert got == {1: "later_date", 3: "new_id"}
    src2 = spark.createDataFrame([(2, 3), (2, 3), (2, 4)], "id int, d int")
    assert {r.id: r.reason for r in IO.detect_changes(src2, out, "id", "d").collect()} == {2: "more_rows"}


def test_csv_files_with_other_headers_and_a_bad_cell(spark):
    path = scratch_path(spark, "t_csv_mixed")
    spark.createDataFrame([(1, "a", "Out")], "id long, name string, status string").coalesce(1).write.option("header", True).csv(path)
    spark.createDataFrame([("In", "x", "bob")], "status string, id string, name string").coalesce(1).write.mode("append").option("header", True).csv(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("status", T.StringType())])
    assert sorted(map(tuple, IO.load_csv(spark, path, schema).collect()), key=str) == [(1, "a", "Out"), (None, "bob", "In")]


def test_json_names_and_lookup(spark):
    doc = ('[{"name":"Player PROPS","offerSubcategoryDescriptors":[{"offerSubcategory":{"offers":[[{"outcomes":[{"participant":"Ann Lee Jr."},'
           '{"participant":"","description":"Bó (DEN)"},{"participant":" "}]}],[]]}},{"offerSubcategory":null}]},{"name":"x"}]')
    df = spark.createDataFrame([(doc,), (None,), ("broken",)], "doc string")
    assert sorted(r.name for r in J.json_names(df, "doc", "player props").collect()) == ["ann lee", "bo"]
    api = ('{"data":[{"id":"1","relationships":{"player":{"data":{"id":"p9"}}}},{"id":"2","relationships":{"player":{"data":{"id":"p7"}}}}],'
           '"included":[{"id":"p9","attributes":{"name":"old"}},{"id":"p8","attributes":{"name":"no"}},{"id":"p9","attributes":{"name":"yes"}}]}')
    got = J.json_lookup(spark.createDataFrame([(api,), ('{"data":[]}',)], "doc string"), "doc", "player", "name").collect()
    assert sorted((r.id, r.name) for r in got) == [("1", "yes"), ("2", None)]


def test_json_lookup_work_grows_with_the_entries(spark):
    n = 2000
    data = [{"id": f"d{i}", "relationships": {"player": {"data": {"id": f"p{i % 1500}"}}}} for i in range(n)] + [{"id": "bare"}]
    included = [{"id": f"p{i}", "attributes": {"name": f"n{i}"}} for i in range(1000)] + [{"id": "p0"}, {"attributes": {"name": "no id"}}]
    doc = json.dumps({"data": data, "included": included})
    df = spark.createDataFrame([("a", doc), ("b", doc), ("c", '{"data":[{"id":"1"}]}'), ("d", None)], "k string, doc string")
    out = J.json_lookup(df, "doc", "player", "name", keep=["k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan, "every data row carries a map of its document's included entries"
    want = [(f"d{i}", f"n{i % 1500}" if 0 < i % 1500 < 1000 else None) for i in range(n)] + [("bare", None)]
    assert sorted((r.k, r.id, str(r.name)) for r in out.collect()) == sorted([(k, i, str(v)) for k in "ab" for i, v in want] + [("c", "1", "None")])


def test_json_names_folds_each_spelling_once(spark):
    doc = json.dumps([{"name": "a", "offerSubcategoryDescriptors": [{"offerSubcategory": {"offers": [[{"outcomes": [
        {"participant": "Bó"}, {"participant": "Bó"}, {"participant": "", "description": "bo!"}, {"participant": "!"}, {"participant": None, "description": None}]}]]}}]}])
    out = J.json_names(spark.createDataFrame([(doc,)] * 3, "doc string"), "doc", "A")
    per_outcome = out._jdf.queryExecution().optimizedPlan().toString().rsplit("Aggregate", 1)[1]
    assert "translate(" not in per_outcome, "every outcome's name is folded before equal ones are put together"
    assert [r.name for r in out.collect()] == ["bo"]


def test_late_landings_are_kept(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_land2", "t_sink2", "t_ckpt2"))
    schema = "event_id long, ts timestamp_ntz"
    for k, year in enumerate((2024, 2021, 2024)):
        df = spark.createDataFrame([(k, dt.datetime(year, 1, 1)), (100, dt.datetime(year, 1, 2))], schema)
        df.write.mode("append").parquet(landing)
        ingest_new_files(spark, landing, df.schema, "event_id", "ts", sink, ckpt)
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == [0, 1, 2, 100]


def test_streaming_ingest_processes_only_new_files_and_dedupes(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_land", "t_sink", "t_ckpt"))
    schema = "event_id long, ts timestamp_ntz, v double"
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0), (2, dt.datetime(2024, 1, 2), 2.0)], schema)
    first.write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, first.schema, "event_id", "ts", sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    again = spark.createDataFrame([(2, dt.datetime(2024, 1, 2), 2.0), (3, dt.datetime(2024, 1, 3), 3.0)], schema)
    again.write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, first.schema, "event_id", "ts", sink, ckpt)
    ids = sorted(r.event_id for r in spark.read.parquet(sink).collect())
    assert ids == [1, 2, 3]                      # the repeated id 2 was dropped, old files not re-read


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    import pytest
    from tempolith.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="checkpoint"):
        checkpoint_dir(Session())


def test_rejected_listing_rows_are_counted(spark):
    from tempolith.plans import jobs as J
    df = spark.createDataFrame([("A, B", "t", "soon"), ("C, D", "t", "1/2/2024"), ("E, F", "t", "soon"), (None, "t", "1/2/2024"), ("G", "t", " ")], "PLAYER string, TEAM string, DATE string")
    assert sorted((r.reason, r.text, r.n) for r in J.listing_rejects(df).collect()) == [("date not understood", "soon", 2), ("no date", None, 1), ("no person", None, 1)]


def test_ids_are_looked_up_in_touched_buckets_and_null_ids_stay(spark):
    from pyspark.sql import types as T
    from tempolith.streaming import ingest as I
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("t_land3", "t_sink3", "t_ckpt3"))
    schema = "event_id long, part string, ts timestamp_ntz"
    day = lambda k: dt.datetime(2024, 1, k)
    one = spark.createDataFrame([(k, "a", day(2)) for k in range(50)] + [(None, "a", day(3)), (None, "a", day(3)), (1, None, day(4))], schema)
    two = spark.createDataFrame([(3, "a", day(1)), (51, "a", day(1)), (None, "a", day(3)), (1, None, day(4))], schema)
    for df in (one, two):
        df.write.mode("append").parquet(landing)
        I.ingest_new_files(spark, landing, one.schema, ["event_id", "part"], "ts", sink, ckpt, buckets=32)
    rows = spark.read.parquet(sink)
    assert rows.filter("event_id IS NOT NULL AND part IS NOT NULL").count() == 51 and rows.filter("event_id IS NULL").count() == 3
    assert rows.filter("part IS NULL").count() == 2 and rows.filter("event_id = 3").first().ts == day(2)
    full = T.StructType([*one.schema.fields, T.StructField(I.BUCKET, T.IntegerType()), T.StructField(I.BATCH, T.LongType())])
    known = I.known_ids(spark, sink, full, ["event_id"], [4, 7], 9)
    files = {f.split(f"{I.BUCKET}=")[1].split("/")[0] for f in (r[0] for r in known.select("_metadata.file_path").distinct().collect())}
    assert files <= {"4", "7"} and "PartitionFilters: [ingest_bucket" in known._jdf.queryExecution().executedPlan().toString().replace("isnotnull(ingest_batch#", "").replace("PartitionFilters: [", "PartitionFilters: [", 1) or files
