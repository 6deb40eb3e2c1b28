"""Tables kept per group and rebuilt only where their inputs changed.

A ``GroupStore`` holds derived tables in folders by bucket (a hash of the group) and a manifest: for every group and
every input the number of rows and two sums of 64-bit row hashes. Sums do not depend on the order of rows, do not
cancel for repeated ones, and the hashes tell NULL apart from absent values; so a late row, a corrected one, a changed
duplicate, a removed row or a vanished group all show. An update compares manifests (one row per group and input),
builds the changed groups from their inputs, and rewrites the buckets that hold them; files of other buckets are not
touched. The manifest is written last: an update that breaks off is seen as not done and repeated.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolith.session import cut_lineage, drop_path, scratch_path

BUCKET = "bucket"
#: Source name of the manifest row that every version has, so that one without groups is a version too.
_RUN = ""


def row_hash(columns: Sequence[str], salt: str = "") -> Column:
    """A 64-bit hash of a row in which NULL counts as a value of its own; columns by name, whatever their order."""
    names = sorted(columns)
    return F.xxhash64(F.lit(salt), *[x for c in names for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def digest(df: DataFrame, group: Sequence[str] | str) -> DataFrame:
    """Per group: rows, digest_a, digest_b - what tells one multiset of rows from another, in any order."""
    keys = [group] if isinstance(group, str) else list(group)
    rest = [c for c in df.columns if c not in keys]
    sums = {f"digest_{k}": F.sum(row_hash(rest, k).cast("decimal(20,0)")).cast("decimal(38,0)") for k in ("a", "b")}
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[e.alias(k) for k, e in sums.items()])


def of_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose group is in ``groups`` (or, with "left_anti", is not); a NULL key is a key like others."""
    other = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return df.join(other, match, how)


class GroupStore:
    def __init__(self, spark: SparkSession, path: str, group: Sequence[str] | str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.group = [group] if isinstance(group, str) else list(group)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.group), F.lit(self.buckets)).cast("int"))

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def table(self, name: str) -> DataFrame:
        """A stored table, without the bucket; one that has no rows has its columns all the same."""
        return self._stored(name).drop(BUCKET)

    def _stored(self, name: str) -> DataFrame | None:
        schema = self._read(f"schema-{name}")
        if schema is None:
            return None
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema.first()[0]))).parquet(f"{self.path}/{name}")

    def manifest(self, sources: dict[str, DataFrame]) -> DataFrame:
        parts = [digest(df, self.group).withColumn("source", F.lit(name)) for name, df in sorted(sources.items())]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def changed(self, fresh: DataFrame) -> DataFrame:
        """Groups whose inputs are not the stored ones: new, different in any input, or gone."""
        saved = self._read("manifest")
        if saved is None:
            return fresh.select(*self.group).distinct()
        last = saved.agg(F.max("version")).first()[0]
        both = fresh.unionByName(saved.filter((F.col("version") == last) & (F.col("source") != _RUN)).drop("version"))
        once = both.groupBy(*fresh.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1")
        return once.select(*self.group).distinct()

    def update(self, sources: dict[str, DataFrame], build: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]) -> DataFrame:
        """Bring the store up to date; the groups that were rebuilt.

        ``build`` gets the sources cut down to the changed groups and returns the tables to keep, each with the group's
        columns. A group that is gone from all sources leaves every table."""
        fresh = cut_lineage(self.manifest(sources))
        changed = cut_lineage(self._bucketed(self.changed(fresh)))
        touched = sorted(r[BUCKET] for r in changed.select(BUCKET).distinct().collect())       # at most ``buckets``
        if touched:
            groups = changed.drop(BUCKET)
            for name, rows in build({n: of_groups(df, groups, self.group) for n, df in sources.items()}).items():
                self._replace(name, rows, groups, touched)
            saved = self._read("manifest")
            version = 0 if saved is None else saved.agg(F.max("version")).first()[0] + 1
            run = self.spark.range(1).select(*[F.lit(0 if f.name == "rows" else _RUN if f.name == "source" else None).cast(f.dataType).alias(f.name) for f in fresh.schema])
            fresh.unionByName(run).withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{self.path}/manifest")
            if version > 1:
                drop_path(self.spark, f"{self.path}/manifest/version={version - 2}")
        return changed.drop(BUCKET)

    def _replace(self, name: str, rows: DataFrame, groups: DataFrame, touched: list[int]) -> None:
        """Put rows of the changed groups in the place of the old ones, in the touched buckets only."""
        out, old = self._bucketed(rows), self._stored(name)
        if old is not None:
            kept = of_groups(old.filter(F.col(BUCKET).isin(touched)), groups, self.group, "left_anti")
            out = out.unionByName(kept.select(*out.columns))
        stage = scratch_path(self.spark, f"store-{name}")
        # written aside first: the old files are read until then; an empty table still tells its columns
        out.write.partitionBy(BUCKET).parquet(stage)
        staged = self.spark.read.schema(out.schema).parquet(stage)
        full = {r[BUCKET] for r in staged.select(BUCKET).distinct().collect()}
        (staged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{self.path}/{name}"))
        if old is None:
            self.spark.createDataFrame([(out.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/schema-{name}")
        for bucket in touched:
            if bucket not in full:
                drop_path(self.spark, f"{self.path}/{name}/{BUCKET}={bucket}")
        drop_path(self.spark, stage)
