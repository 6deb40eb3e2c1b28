"""Suffix dedup: bytes covered by a 200-byte string that starts anywhere else are removed.

A distributed difference-cover suffix sort, stopped at the 200 bytes that decide. Every start of a text is a suffix;
the cover is chosen by content instead of by residues, so that equal suffixes are sampled alike wherever they stand:

1. Sample. The cover holds, for each start, the place of the smallest hash among the next ``WINDOW`` runs of
   ``RUN`` bytes. Equal 200-byte prefixes choose the same place in themselves. About one start in 48 is sampled, where
   residues modulo 3 would sample two in three.
2. Sort and name. A sampled suffix gets a name for its first ``KEY`` bytes; names are grouped over the corpus, and
   only suffixes whose name occurs twice (``ties``) go on. All others are decided: they equal nothing.
3. Recurse. Sampled suffixes that tie are named anew by triples: the bytes that their starts hold before the sample, the
   key, and the bytes after it up to the 200th of the last start. Two equal triples decide all their starts at once.
4. Merge the remaining suffixes. Starts whose triple is unique, and those of one representative of each other triple of
   the same name, become rows (their bytes up to the sample, and the rest of the 200), dealt and grouped so that equal
   prefixes are adjacent. A start whose prefix has an equal neighbour is repeated.

Names are 128-bit or 64-bit fingerprints rather than ranks: only equality of prefixes is asked for, and the order between
different ones is never used. Texts that are equal as a whole are one text with a count; a text of at least 200 bytes
that has a copy is repeated everywhere. Results are exact up to fingerprint collisions (about n^2 / 2^65 for the 64 bits
of a key, which cost work only, and n^2 / 2^129 for the 128 bits that decide).

A null text is empty. Texts of fewer than 200 bytes lose nothing. Matches never cross rows, and rows with one id
are different rows. Very long texts are read whole. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import RangeHash, Scratch, blocks, table
from tempolith.llm.registry import query

LENGTH = 200
#: Starts that one sample serves, bytes whose hash is compared to choose it, and bytes that all its starts share after it.
WINDOW, RUN = 96, 16
KEY = LENGTH - WINDOW + 1
_UPPER = np.uint64(0xFFFFFFFF00000000)


class Text:
    """Samples of a block of texts: place, first and last start that choose it, and its text."""

    def __init__(self, texts: list[bytes], sample: bool = True):
        self.buf = buf = np.frombuffer(b"".join(texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(size)])
        self.hash = RangeHash(buf)
        if sample:
            self._sample(buf, size)

    def _sample(self, buf: np.ndarray, size: np.ndarray) -> None:
        enough = np.flatnonzero(size >= LENGTH)
        if not len(enough):
            self.place = self.low = self.high = self.doc = np.empty(0, np.int64)
            return
        # hash in the upper half, place in the lower: the smallest is the leftmost of the smallest hashes
        runs = len(buf) - RUN + 1
        packed = np.full(runs + -runs % WINDOW, _UPPER, np.uint64)
        packed[:runs] = self.hash.runs(RUN)
        packed[:runs] &= _UPPER
        packed[:runs] |= np.arange(runs, dtype=np.uint64)
        square = packed.reshape(-1, WINDOW)
        head, tail = np.empty_like(square), np.empty_like(square)
        np.minimum.accumulate(square, axis=1, out=head)
        np.minimum.accumulate(square[:, ::-1], axis=1, out=tail[:, ::-1])
        chosen = np.minimum(tail.ravel()[: len(packed) - WINDOW + 1], head.ravel()[WINDOW - 1:])
        # a sample begins where the choice changes, or a text's starts begin; it ends before the next, or with them
        begin, stop = self.offset[enough], self.offset[enough + 1] - LENGTH + 1
        change = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
        text = np.searchsorted(begin, change, side="right") - 1
        inside = (text >= 0) & (change > begin[text]) & (change < stop[text])
        self.low = np.sort(np.concatenate([begin, change[inside]]))
        text = np.searchsorted(begin, self.low, side="right") - 1
        self.doc = enough[text]
        self.high = np.minimum(np.append(self.low[1:], len(buf)), stop[text]) - 1
        self.place = (chosen[self.low] & ~_UPPER).astype(np.int64)

    def names(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each range, as two columns."""
        if not hasattr(self, "second"):
            self.second = RangeHash(self.buf, 1)
        return self.hash.of(start, end).view(np.int64), self.second.of(start, end).view(np.int64)


def route(digest: bytes) -> int:
    """64 bits of a text's MD5, under which its sample names travel; texts are told apart by all 128."""
    return int.from_bytes(digest[:8], "big", signed=True)


def _keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, md, twice): names of a text's samples, once each, and whether it holds one twice."""
    for frame in frames:
        for block in blocks([(None, bytes(r)) for r in frame["raw"]]):
            t = Text([r for _, r in block])
            if not len(t.place):
                continue
            key = t.hash.of(t.place, t.place + KEY).view(np.int64)
            order = np.lexsort((key, t.doc))
            key, doc = key[order], t.doc[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
            twice = np.diff(np.append(np.flatnonzero(new), len(key))) > 1
            md = np.array([route(hashlib.md5(r).digest()) for _, r in block], np.int64)
            yield pd.DataFrame({"key": key[new], "md": md[doc[new]], "twice": twice})


def _triples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Samples whose key ties: key, name of the bytes of all their starts, text, place, starts."""
    for frame in frames:
        rows = [(k, bytes(r)) for k, r in enumerate(frame["raw"])]
        for block in blocks(rows):
            t = Text([r for _, r in block])
            key = t.hash.of(t.place, t.place + KEY).view(np.int64)
            first = np.searchsorted(t.doc, np.arange(len(block) + 1))
            tied = np.concatenate([np.isin(key[first[k]:first[k + 1]], frame["keys"].iloc[at]) for k, (at, _) in enumerate(block)] or [np.empty(0, bool)])
            place, low, high, doc, key = (x[tied] for x in (t.place, t.low, t.high, t.doc, key))
            one, two = t.names(low, high + LENGTH)
            at, base = np.array([k for k, _ in block], np.int64)[doc], t.offset[doc]
            yield pd.DataFrame({"key": key, "t1": one, "t2": two + (place - low), "md5": frame["md5"].to_numpy()[at], "copied": frame["copied"].to_numpy()[at],
                                "place": place - base, "low": low - base, "high": high - base})


def _starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each start of the open samples: the name of its 200 bytes, and who it is."""
    columns = ["oid", "place", "low", "high", "single"]
    for frame in frames:
        for block in blocks([(k, bytes(r)) for k, r in enumerate(frame["raw"])]):
            rows = frame.iloc[[k for k, _ in block]]
            t = Text([r for _, r in block], sample=False)
            oid, place, low, high, single = (np.concatenate(rows[c].to_list()) for c in columns)
            base = np.repeat(t.offset[:-1], [len(x) for x in rows["oid"]])
            n = high - low + 1
            back = np.repeat(place - low, n) - (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            start = np.repeat(place + base, n) - back
            one, two = t.names(start, start + LENGTH)
            yield pd.DataFrame({"s1": one, "s2": two, "who": np.repeat(oid, n) * 256 + back, "single": np.repeat(single, n)})


def spans_of(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the 200-byte strings that start in the given ranges."""
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(high[order] + LENGTH)
    cut = np.flatnonzero(np.concatenate([[True], low[1:] > end[:-1]]))
    return list(zip(low[cut].tolist(), end[np.append(cut[1:], len(low)) - 1].tolist()))


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for md5, raw, low, high in zip(frame["md5"], frame["raw"], frame["low"], frame["high"]):
            raw = bytes(raw)
            spans = spans_of(low, high)
            keep = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(raw)]))
            rows.append((md5, [{"start": a, "end": b} for a, b in spans], hashlib.sha256(keep).hexdigest()))
        yield pd.DataFrame(rows, columns=["md5", "spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, spans (array of start and end of each maximal removed run), kept_sha256."""
    stage = Scratch(docs.sparkSession, "suffix")
    raw = docs.select(F.col(id_col).alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("raw"))
    raw = raw.withColumn("md5", F.unhex(F.md5("raw"))).withColumn("n_bytes", F.octet_length("raw").cast("long"))
    long = raw.filter(F.col("n_bytes") >= LENGTH)
    copies = stage.keep(long.groupBy("md5").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("md5"), "copies")

    # sort the sampled suffixes by name; a name ties if different texts hold it, or one text twice
    names = stage.keep(long.select("raw").mapInPandas(_keys, "key long, md long, twice boolean"), "names")
    ties = names.groupBy("key").agg(F.min("md").alias("a"), F.max("md").alias("b"), F.max("twice").alias("twice")).filter("twice OR a <> b").select("key")
    ties = stage.keep(ties, "ties")
    lists = stage.keep(names.select("key", "md").join(ties, "key").groupBy("md").agg(F.collect_set("key").alias("keys")), "lists")
    stage.drop("names")
    md = F.conv(F.substring(F.hex("md5"), 1, 16), 16, -10).cast("long")
    tied = long.select("md5", "raw").withColumn("md", md).join(lists, "md").groupBy("md5").agg(F.first("raw").alias("raw"), F.first("keys").alias("keys"))
    tied = tied.join(copies.withColumn("copied", F.lit(True)), "md5", "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    tied = stage.keep(tied, "tied")
    stage.drop("ties", "lists")

    # triples: equal ones decide all of their starts
    triples = stage.keep(tied.mapInPandas(_triples, "key long, t1 long, t2 long, md5 binary, copied boolean, place long, low long, high long"), "triples")
    classes = stage.keep(triples.groupBy("key", "t1", "t2").agg(F.count(F.lit(1)).alias("n"), F.max("copied").alias("copied"),
                                                                F.min(F.struct("md5", "place", "low", "high")).alias("one")), "classes")
    alone = (F.col("n") == 1) & ~F.col("copied")
    mixed = classes.filter(alone).select("key").distinct()
    opened = classes.join(mixed, "key", "left_semi").select("one.*", alone.alias("single")).withColumn("oid", F.monotonically_increasing_id())
    opened = stage.keep(opened, "opened")
    decided = triples.filter("NOT copied").join(classes.filter(~alone).select("key", "t1", "t2"), ["key", "t1", "t2"], "left_semi").select("md5", "low", "high")
    decided = stage.keep(decided, "decided")
    stage.drop("triples", "classes")

    # the remaining suffixes: starts of single triples, against each other and one of each other triple
    by_text = opened.groupBy("md5").agg(F.collect_list(F.struct("oid", "place", "low", "high", "single")).alias("opened"))
    work = stage.keep(tied.select("md5", "raw").join(by_text, "md5").select("raw", *[F.col(f"opened.{c}").alias(c) for c in ("oid", "place", "low", "high", "single")]), "work")
    starts = work.mapInPandas(_starts, "s1 long, s2 long, who long, single boolean")
    equal = stage.keep(starts.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("open")).filter("n > 1 AND open").select("s1", "s2"), "equal")
    hits = starts.filter("single").select("s1", "s2", "who").join(equal, ["s1", "s2"], "left_semi").select(F.shiftright("who", 8).alias("oid"), (F.col("who") % 256).alias("back"))
    hits = stage.keep(hits, "hits")
    stage.drop("work", "equal")
    found = hits.join(opened.select("oid", "md5", "place"), "oid").select("md5", (F.col("place") - F.col("back")).alias("low")).withColumn("high", F.col("low"))
    ranges = decided.unionByName(found).groupBy("md5").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    ranges = ranges.select("md5", F.col("ranges.low").alias("low"), F.col("ranges.high").alias("high"))
    cut = tied.filter("NOT copied").select("md5", "raw").join(ranges, "md5").mapInPandas(_cut, "md5 binary, spans array<struct<start:long,end:long>>, kept_sha256 string")
    cut = stage.keep(cut, "cut")
    stage.drop("tied", "opened", "decided", "hits")

    rows = raw.select("doc_id", "md5", "n_bytes", F.sha2("raw", 256).alias("whole")).join(cut, "md5", "left").join(copies.withColumn("copied", F.lit(True)), "md5", "left")
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return rows.select("doc_id", "n_bytes", F.when(F.col("copied"), all_).otherwise(F.coalesce("spans", none)).alias("spans"),
                       F.when(F.col("copied"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
