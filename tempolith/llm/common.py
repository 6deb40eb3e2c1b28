"""Helpers that the operators share: table access, scratch tables, and hashing of byte ranges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolith.session import drop_path, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


#: Removes an execution's shuffle files when it ends; what it wrote is read from the table.
_CLEAN = "spark.sql.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Stage tables in the folder that the cluster shares; dropped when nothing reads them any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{step}")
        before = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(_CLEAN) if before is None else self.spark.conf.set(_CLEAN, before)
        self.paths[step] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *steps: str) -> None:
        for step in steps or list(self.paths):
            drop_path(self.spark, self.paths.pop(step))


# ---------------------------------------------------------------- hashing of byte ranges
#: Bytes of text that are worked on at a time; a longer text makes a block of its own.
BLOCK = 1 << 20
_MULT = 0x9E3779B97F4A7C15
#: Odd bases of the two independent hash functions.
_BASES = (_MULT, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    held = x >> np.uint64(30)
    x = held ^ x
    for factor, shift in ((0xBF58476D1CE4E5B9, 27), (0x94D049BB133111EB, 31)):
        x *= np.uint64(factor)
        np.right_shift(x, np.uint64(shift), out=held)
        x ^= held
    return x


_BYTES = [mix(np.arange(k, k + 256, dtype=np.uint64) * np.uint64(_MULT)) | np.uint64(1) for k in (1, 5001)]


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; up to a few blocks' worth is kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK + 1024)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * BLOCK:
            _powers[base] = have
    return have[:n]


class RangeHash:
    """64-bit fingerprints of any ranges of a byte buffer, equal for equal content wherever it stands."""

    def __init__(self, buf: np.ndarray, function: int = 0):
        n, base = len(buf), _BASES[function]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[function][buf] * powers(base, n), out=self.sums[1:])
        self.back = powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def runs(self, n: int) -> np.ndarray:
        """Of every run of n bytes, by its start."""
        return mix((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n])


def blocks(items: Iterable[tuple], text: int = 1) -> Iterator[list[tuple]]:
    """Group rows so that a group's texts hold about a block of bytes; a longer text is alone."""
    group, held = [], 0
    for item in items:
        n = len(item[text])
        if group and held + n > BLOCK:
            yield group
            group, held = [], 0
        group.append(item)
        held += n
    if group:
        yield group


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


#: Words of more bytes are hashed by a digest: whatever its base, a polynomial modulo 2 ** 64 gives some long strings that
#: differ in every second place one value, which takes 1,024 bytes at least.
LONG_WORD = 64


class Words:
    """Words of a block of texts: their hashes, the text each stands in, and where it starts and ends."""

    def __init__(self, texts: list[bytes], space: np.ndarray = _SPACE):
        joined = b" ".join(texts) + b" "
        buf = np.frombuffer(joined, np.uint8)
        gap = space[buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = RangeHash(buf).of(self.start, self.end)
        for k in np.flatnonzero(self.end - self.start > LONG_WORD):
            self.hash[k] = int.from_bytes(hashlib.blake2b(joined[self.start[k]:self.end[k]], digest_size=8).digest(), "little")
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        self.doc = np.searchsorted(self.offset, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of n words within a text, and the index of its first word."""
        if len(self.hash) < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.flatnonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1:])
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            total = total * np.uint64(_MULT) + self.hash[at + k]
        return mix(total ^ np.uint64(n)), at


# ---------------------------------------------------------------- rows and running sums
#: Parts into which rows without an id are dealt when they are numbered.
NO_ID_PARTS = 4096


def numbered(df: DataFrame, id_col: str, *order: Column) -> DataFrame:
    """``__occ``: numbers that tell the rows of an id apart in a later join: 1, 2, ... in ``order``.

    Rows without an id do not meet in one task: they are dealt by a hash of the order columns, and their numbers are
    those of their part, ``NO_ID_PARTS`` apart. Two calls over the same rows give the same numbers.
    """
    part = F.when(F.col(id_col).isNull(), F.pmod(F.xxhash64(*order), F.lit(NO_ID_PARTS)))
    place = F.row_number().over(Window.partitionBy(id_col, "__part").orderBy(*order)).cast("long")
    return (df.withColumn("__part", part).withColumn("__occ", place)
            .withColumn("__occ", F.when(F.col("__part").isNull(), F.col("__occ")).otherwise((F.col("__occ") - 1) * NO_ID_PARTS + F.col("__part") + 1)).drop("__part"))


def running_sum(df: DataFrame, order: list[str], value: str, stage: Scratch, step: str, out: str = "__before") -> DataFrame:
    """Sum of ``value`` over all rows before each row in the total order, by range partitions.

    Rows are dealt by range, written once (the partition a row is in must not change between reads), summed
    inside each partition, and moved up by the totals of the partitions before: one row per partition.
    """
    held = stage.keep(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), step)
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = held.groupBy("__part").agg(F.sum(value).alias("__total"))
    ahead = totals.select("__part", (F.sum("__total").over(Window.orderBy("__part")) - F.col("__total")).alias("__ahead"))
    return (held.withColumn(out, F.sum(value).over(inside) - F.col(value)).join(F.broadcast(ahead), "__part")
            .withColumn(out, F.col(out) + F.col("__ahead")).drop("__part", "__ahead"))
