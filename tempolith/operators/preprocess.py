"""Composed preprocessing and its fitted state (M2-M8): fit once, save, load, apply.

Numeric columns are filled with train medians, standardised and reduced by PCA;
categorical columns become indicators, of which those that hardly vary are
left out, in a column of ``max_categories`` or more they become one sparse vector;
index columns become integers (0 for unseen values); prior columns are
filled with 0 and standardised.  Everything fitted is a small table or a Spark ML
model, so it can be written beside the model and read at scoring time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.operators import prep as P
from tempolith.session import cut_lineage

MISSING = "missing"


@dataclass
class Preprocessor:
    numeric: list[str]
    categorical: list[str]
    index: list[str]
    priors: list[str]
    components: int = 0
    indicators: list[tuple[str, str]] = field(default_factory=list)   # (column, category) that are kept
    tables: dict[str, DataFrame] = field(default_factory=dict)
    pca: PCAModel | None = None
    #: columns with too many categories for one column each, and the width of their sparse vectors
    sparse: dict[str, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), index: Sequence[str] = (),
            priors: Sequence[str] = (), variance: float = 0.95, least_variance: float = 1e-4, max_categories: int = 1000) -> Preprocessor:
        """``max_categories`` is how many categories get a column each; one with more of them gets a sparse vector, whose
        categories (those that vary enough) are counted, filtered and numbered in Spark."""
        self = cls(list(numeric), list(categorical), list(index), list(priors))
        if self.numeric:
            self.tables["medians"] = P.exact_medians(train, self.numeric)
            filled = P.fill_medians(train, self.tables["medians"], self.numeric)
            self.tables["moments"] = P.fit_scaler(filled, self.numeric)
            vec = VectorAssembler(inputCols=self.numeric, outputCol="_vec").transform(P.scale(filled, self.tables["moments"], self.numeric))
            self.pca = PCA(k=len(self.numeric), inputCol="_vec", outputCol="_pca").fit(vec)
            self.components = P.kept_components(self.pca, variance)
        for c in self.categorical:
            key = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
            counts = train.groupBy(key.alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy("v").limit(max_categories + 1).collect()
            if len(counts) > max_categories:
                sizes = train.groupBy(key.alias(c)).agg(F.count(F.lit(1)).alias("n"))
                share = F.col("n") / F.lit(float(train.count()))
                self.tables[f"sparse_{c}"] = cut_lineage(P.global_index(sizes.filter(share * (1 - share) > least_variance).select(c), c, "at", start=0))
                self.sparse[c] = self.tables[f"sparse_{c}"].count()
                continue
            if len(counts) == 2:
                kept = counts[1:]
            else:
                kept = counts
            total = sum(r["n"] for r in counts)
            share = {r["v"]: r["n"] / total for r in kept}
            self.indicators += [(c, v) for v, p in share.items() if p * (1 - p) > least_variance]
        for c in self.index:
            self.tables[f"index_{c}"] = P.fit_index(train, c)
        if self.priors:
            self.tables["priors"] = P.fit_scaler(train.fillna(0.0, subset=self.priors), self.priors)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with pc_1.., {column}_{category}, {column}_idx and the standardised priors; the numeric columns are replaced by pc_*."""
        if self.numeric:
            df = P.scale(P.fill_medians(df, self.tables["medians"], self.numeric), self.tables["moments"], self.numeric)
            df = self.pca.transform(VectorAssembler(inputCols=self.numeric, outputCol="_vec").transform(df)).withColumn("_pca", vector_to_array("_pca"))
            df = df.withColumns({f"pc_{k + 1}": F.col("_pca")[k] for k in range(self.components)}).drop("_vec", "_pca", *self.numeric)
        if self.indicators:
            df = df.withColumns({f"{c}_{v}": (F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) == v).cast("double") for c, v in self.indicators})
        for c, width in self.sparse.items():
            table = self.tables[f"sparse_{c}"].select(F.col(c).alias("_cat"), F.col("at").alias("_at"))
            df = df.withColumn("_key", F.coalesce(F.col(c).cast("string"), F.lit(MISSING))).join(table, F.col("_key") == F.col("_cat"), "left")
            df = df.withColumn(f"{c}_vec", F.struct(F.lit(width).alias("size"), F.when(F.col("_at").isNull(), F.array().cast("array<int>")).otherwise(F.array("_at")).alias("indices"),
                                                    F.when(F.col("_at").isNull(), F.array().cast("array<double>")).otherwise(F.array(F.lit(1.0))).alias("values"))).drop("_key", "_cat", "_at")
        for c in self.index:
            df = P.apply_index(df, self.tables[f"index_{c}"], c)
        if self.priors:
            df = P.scale(df.fillna(0.0, subset=self.priors), self.tables["priors"], self.priors)
        return df

    @property
    def features(self) -> list[str]:
        return [f"pc_{k + 1}" for k in range(self.components)] + [f"{c}_{v}" for c, v in self.indicators]

    def assembled(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``transform`` with all features in one sparse vector ``struct<size, indices, values>``: the dense ones (PCA part
        and indicators) first, then each sparse column's."""
        df = self.transform(df)
        dense = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in self.features]) if self.features else F.array().cast("array<double>")
        at, indices, values = len(self.features), [F.sequence(F.lit(0), F.lit(len(self.features) - 1)) if self.features else F.array().cast("array<int>")], [dense]
        for c, width in self.sparse.items():
            start = F.lit(at)
            indices.append(F.transform(F.col(f"{c}_vec.indices"), lambda i: i + start))  # noqa: B023 - called at once
            values.append(F.col(f"{c}_vec.values"))
            at += width
        return df.withColumn(out, F.struct(F.lit(at).alias("size"), F.concat(*indices).alias("indices"), F.concat(*values).alias("values")))

    def save(self, spark: SparkSession, path: str) -> None:
        lists = [(kind, i, a, b) for kind, values in (("numeric", self.numeric), ("categorical", self.categorical), ("index", self.index), ("priors", self.priors))
                 for i, (a, b) in enumerate((v, None) for v in values)]
        lists += [("indicator", i, c, v) for i, (c, v) in enumerate(self.indicators)] + [("components", self.components, "", None)]
        lists += [("sparse", width, c, str(i)) for i, (c, width) in enumerate(self.sparse.items())]
        spark.createDataFrame(lists, "kind string, position int, name string, category string").write.mode("overwrite").parquet(f"{path}/spec")
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        if self.pca is not None:
            self.pca.write().overwrite().save(f"{path}/pca")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        spec: dict[str, list] = {}
        for r in spark.read.parquet(f"{path}/spec").orderBy("kind", "position").collect():
            spec.setdefault(r["kind"], []).append(r)
        names = lambda kind: [r["name"] for r in spec.get(kind, [])]      # noqa: E731
        self = cls(names("numeric"), names("categorical"), names("index"), names("priors"), spec["components"][0]["position"],
                   [(r["name"], r["category"]) for r in spec.get("indicator", [])])
        self.sparse = {r["name"]: r["position"] for r in sorted(spec.get("sparse", []), key=lambda r: int(r["category"]))}
        tables = (["medians", "moments"] if self.numeric else []) + [f"sparse_{c}" for c in self.sparse] + [f"index_{c}" for c in self.index] + (["priors"] if self.priors else [])
        self.tables = {t: spark.read.parquet(f"{path}/{t}") for t in tables}
        self.pca = PCAModel.load(f"{path}/pca") if self.numeric else None
        return self


def save_ensemble(spark: SparkSession, fitted, path: str) -> None:
    """Fitted members (``uncertainty.fit_ensemble``) as a table."""
    spark.createDataFrame([(t, m, [float(b) for b in beta], float(lv)) for t, m, beta, lv in fitted],
                          "target string, member int, beta array<double>, logvar double").write.mode("overwrite").parquet(path)


def load_ensemble(spark: SparkSession, path: str) -> list[tuple[str, int, list[float], float]]:
    """One row per target and member."""
    return [(r["target"], r["member"], list(r["beta"]), r["logvar"]) for r in spark.read.parquet(path).orderBy("target", "member").collect()]
