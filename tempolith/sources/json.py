"""Nested JSON documents (A7, A8, F18) with from_json + explode, no Python parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolith.functions.text import folded_key

# Schema of the nested "markets" document read by ``json_names``.
MARKET_SCHEMA = ("array<struct<name:string,offerSubcategoryDescriptors:array<struct<offerSubcategory:struct<offers:array<array<struct<"
                 "outcomes:array<struct<participant:string,description:string>>>>>>>>>>")

# Schema of a JSON:API style document read by ``json_lookup``.
JSONAPI_SCHEMA = ("struct<data:array<struct<id:string,relationships:map<string,struct<data:struct<id:string>>>>>,"
                  "included:array<struct<id:string,attributes:map<string,string>>>>")


# A7 -----------------------------------------------------------------------------
def json_names(df: DataFrame, col: str, category: str) -> DataFrame:
    """Distinct names (folded keys) under the category of that name, in any case:
    categories -> subcategories -> lists of offers -> outcomes; the participant,
    or where that is empty the description; blanks are dropped."""
    cats = df.select(F.explode(F.from_json(col, MARKET_SCHEMA)).alias("c"))
    cats = cats.filter(F.lower("c.name") == category.lower())
    lists = cats.select(F.explode("c.offerSubcategoryDescriptors").alias("d")).select(F.explode("d.offerSubcategory.offers").alias("l"))
    u = lists.select(F.explode("l").alias("o")).select(F.explode("o.outcomes").alias("u"))
    person = F.col("u.participant")
    # names repeat across documents: each spelling is folded once. The count keeps the optimiser from moving the folding
    # and the test for blanks below the grouping, to every outcome
    raw = u.groupBy(F.when(person != "", person).otherwise(F.col("u.description")).alias("_raw")).agg(F.count(F.lit(1)).alias("_n"))
    return raw.select(folded_key(F.when(F.col("_n") > 0, F.col("_raw"))).alias("name")).filter(F.col("name") != "").distinct()


# A8 -----------------------------------------------------------------------------
def json_lookup(df: DataFrame, col: str, relation: str, attribute: str, keep: list[str] | None = None) -> DataFrame:
    """Resolve ``data[].relationships[relation].data.id`` against ``included[].id``
    and return (data id, attribute value).  A relation without a match gives NULL;
    of two included entries with one id the last counts.

    Both lists are exploded in one go and meet in a window by (digest of the
    document, id), so the work grows with the entries: no row carries its
    document's other entries.  Equal documents share a digest, and with it what
    their ids resolve to."""
    keep = keep or []
    base = df.select(*keep, F.md5(F.col(col).cast("binary")).alias("_doc"), F.from_json(col, JSONAPI_SCHEMA).alias("_j"))
    entry = "array<struct<_k:int,_key:string,_id:string,_v:string>>"    # _k: position of an included entry, NULL for data
    none = F.lit(None).cast("string")
    data = F.transform("_j.data", lambda d: F.struct(F.lit(None).cast("int").alias("_k"), d["relationships"].getItem(relation)["data"]["id"].alias("_key"),
                                                    d["id"].alias("_id"), none.alias("_v")))
    included = F.transform("_j.included", lambda i, k: F.struct(k.alias("_k"), i["id"].alias("_key"), none.alias("_id"),
                                                                i["attributes"].getItem(attribute).alias("_v")))
    both = F.concat(*[F.coalesce(a.cast(entry), F.array().cast(entry)) for a in (data, included)])
    rows = base.select(*keep, "_doc", F.explode(both).alias("_e")).select(*keep, "_doc", "_e.*")
    found = F.max_by("_v", "_k").over(Window.partitionBy("_doc", "_key"))
    rows = rows.withColumn("_found", F.when(F.col("_key").isNotNull(), found))
    return rows.filter(F.col("_k").isNull()).select(*keep, F.col("_id").alias("id"), F.col("_found").alias(attribute))


# F18 ----------------------------------------------------------------------------
def json_scalar(col: str, path: str, cast: str | None = None) -> Column:
    v = F.get_json_object(F.col(col), path)
    return v.try_cast(cast) if cast else v
