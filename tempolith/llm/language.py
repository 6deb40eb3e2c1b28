"""Language ID by compression: the language whose dictionary makes the text smallest.

For each language a zstandard raw-content dictionary is made of excerpts of a bounded sample of labelled rows:
``SLOTS`` rows picked by a hash of the id, ``EXCERPT`` bytes of each, taken at even distances over the whole
text. A text is lower-cased, all but its letters become single spaces, and it is cut, to its end, into windows of a
tenth of it (``NARROW`` bytes at least, ``BLOCK`` at most); every window is compressed with each dictionary. The
smallest sum wins.

A text is rejected where the winner's lead over the runner-up is at most its margin, a share of the winner's size
(``FLOOR`` bytes at least): nothing tells the two apart, as in noise or a language that was not learned. It is also
rejected where the windows that the winner leads in this sense hold at most ``OWN`` of the bytes of all windows that
tell a language: two languages share the text. Windows of less than ``TOLD`` compressed bytes without a leader tell
nothing. A language's margin is a ``PORTION`` of the lead that all but ``TAIL`` of a bounded sample of its labelled rows
exceed; these rows are not in the dictionaries. A language with fewer than ``ENOUGH`` of them has the margin ``SHARE``.

A null text, or one without a letter, is ``und`` with score 0, and rejected. Ties go to the first language by
name (and are rejected). Without labelled rows every text is ``und``. Repeated rows each give their row; an empty
table gives an empty result. Only id, text and language are read; other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, table
from tempolith.llm.registry import query

#: Rows sampled for each language, and bytes taken of each.
SLOTS, EXCERPT, PARTS = 64, 512, 2
#: Largest number of languages that are learned; more labels than this are refused.
LANGUAGES = 500
LEVEL, SHORTEST, WINDOW, BLOCK = 13, 3, 18, 4096
#: Least bytes of a window, and windows of a text that is short enough.
NARROW, WINDOWS = 96, 10
#: Least lead in bytes, and the lead as a share of the size where too few labelled rows tell it.
FLOOR, SHARE = 1, 0.05
#: How margins are set from the leads of labelled rows: bytes read of a row, and at least so many for it to count.
TRIAL, LEAST, ENOUGH, TAIL, PORTION = 16384, 200, 16, 0.05, 1 / 3
#: Share of the telling windows' bytes that the winner must exceed, and compressed bytes from which a window tells.
OWN, TOLD = 0.62, 64
#: Bytes of difference that make a language e times less likely, for the score.
BYTES = 4.0

_KEEP = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def letters(text: str) -> bytes:
    """Lower-case letters, with one space between runs."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_KEEP).split())


def excerpt(data: bytes) -> bytes:
    if len(data) <= EXCERPT:
        return data
    size = EXCERPT // PARTS
    return b" ".join(data[at:at + size] for at in np.linspace(0, len(data) - size, PARTS).astype(int))


def windows(data: bytes) -> list[bytes]:
    """The whole text in order; a last piece of less than half a window belongs to the one before."""
    size = min(BLOCK, max(NARROW, -(-len(data) // WINDOWS)))
    starts = list(range(0, len(data), size))
    if len(starts) > 1 and len(data) - starts[-1] < size // 2:
        starts.pop()
    return [data[i:j] for i, j in zip(starts, [*starts[1:], len(data)])]


class Books(dict):
    """Dictionary of each language, and ``margins``: the lead that each needs as a share of its size."""

    margins: dict[str, float] = {}


def learn(labelled: DataFrame) -> Books:
    """Dictionaries, SLOTS * EXCERPT bytes a language at most, and margins from rows (doc_id, text, lang)."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("doc_id"))
    slots = rows.groupBy("lang", F.pmod("h", F.lit(SLOTS)).alias("slot")).agg(F.min("h").alias("h"), F.max("h").alias("other"))
    # at most SLOTS rows a language on the small side for its dictionary, and as many others for its margin
    picked = slots.limit(SLOTS * LANGUAGES + 1).select("lang", F.col("h").alias("first"), F.explode(F.array_distinct(F.array("h", "other"))).alias("h"))
    picked = picked.select("lang", "h", (F.col("h") != F.col("first")).alias("trial"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            part = [letters(x)[:TRIAL] if t else excerpt(letters(x)) for x, t in zip(f["text"], f["trial"])]
            yield pd.DataFrame({"lang": f["lang"], "h": f["h"], "trial": f["trial"], "part": part})

    stage = Scratch(labelled.sparkSession, "language")
    parts = rows.join(F.broadcast(picked), ["lang", "h"]).select("lang", "h", "trial", "text").mapInPandas(cut, "lang string, h long, trial boolean, part binary")
    parts = stage.keep(parts.groupBy("lang", "h", "trial").agg(F.min("part").alias("part")), "labelled")
    found: dict[str, list[bytes]] = {}
    for row in parts.filter("NOT trial").orderBy("lang", "h").collect():
        found.setdefault(row["lang"], []).append(bytes(row["part"]))
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages among the labels")
    books = Books({lang: b" ".join(p) for lang, p in found.items() if any(p)})
    books.margins = _margins(parts.filter("trial"), books)
    stage.drop()
    return books


def _margins(trials: DataFrame, books: Books) -> dict[str, float]:
    """Margin of each language from labelled rows (lang, part) that its dictionary does not hold."""

    def lead(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(books)
        for f in frames:
            rows = [(lang, sizes) for lang, part in zip(f["lang"], f["part"]) if lang in books and len(part) >= LEAST and len(books) > 1
                    for sizes in [judge.sizes(bytes(part)).sum(0)]]
            yield pd.DataFrame([(x, float(np.delete(s, k).min() - s[k]) / s[k]) for x, s in rows for k in [judge.names.index(x)]], columns=["lang", "lead"])

    leads: dict[str, list[float]] = {}
    for row in trials.mapInPandas(lead, "lang string, lead double").collect():  # at most SLOTS a language
        leads.setdefault(row["lang"], []).append(row["lead"])
    return {lang: max(0.0, PORTION * float(np.quantile(x, TAIL))) for lang, x in leads.items() if len(x) >= ENOUGH}


class Judge:
    def __init__(self, books: dict[str, bytes]):
        self.names = sorted(books)
        margins = getattr(books, "margins", {})
        self.margins = [margins.get(name, SHARE) for name in self.names]
        self.tools = []
        for name in self.names:
            book = zstandard.ZstdCompressionDict(books[name].ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=SHORTEST, window_log=WINDOW, write_checksum=False,
                                                                 write_content_size=False, write_dict_id=False)
            self.tools.append(zstandard.ZstdCompressor(dict_data=book, compression_params=how))

    def sizes(self, data: bytes) -> np.ndarray:
        """Compressed bytes of each window with each language."""
        return np.array([[len(t.compress(c)) for t in self.tools] for c in windows(data)], float)

    def of(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether it is rejected."""
        if not text or not self.tools or not _LETTER.search(text):
            return "und", 0.0, True
        data = letters(text)
        each = self.sizes(data)
        sizes = each.sum(0)
        best = int(sizes.argmin())
        score = float(1 / np.exp(-np.minimum((sizes - sizes[best]) / BYTES, 700)).sum())
        if len(sizes) == 1:
            return self.names[best], score, False
        share = self.margins[best]
        if np.partition(sizes, 1)[1] - sizes[best] <= max(FLOOR, share * sizes[best]):
            return self.names[best], score, True
        first, second = np.partition(each, 1, axis=1)[:, :2].T
        clear = second - first > np.maximum(FLOOR, share * first)
        weight = np.fromiter(map(len, windows(data)), float) * (clear | (first >= TOLD))
        own = weight[clear & (each[:, best] == first)].sum()
        return self.names[best], score, bool(own <= OWN * weight.sum() and weight.any())


def identify(docs: DataFrame, books: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, rejected."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held: list[Judge] = []

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not held:
            held.append(Judge(books))
        for f in frames:
            found = [held[0].of(t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "rejected": [x[2] for x in found]})

    return rows.mapInPandas(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def accepted(books: dict[str, bytes], text: Column) -> Column:
    """Whether a text's language is told clearly enough."""
    held: list[Judge] = []

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(Judge(books))
        return pd.Series([not held[0].of(t)[2] for t in texts], dtype=bool)

    return keep(text)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    books = learn(docs.filter(~F.coalesce(held_out(), F.lit(False))).select("doc_id", "text", "lang"))
    found = identify(docs, books)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
