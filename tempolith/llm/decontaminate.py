"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of letters and digits; marks and white space, of Unicode too, separate them, and in scripts
that are written without spaces every character is a word. Runs of ``SEED`` words
of the test items are counted over the documents; an item's seeds are its rare runs: those in at most ``RARE`` of all
documents, and those in at most twice as many as its median run, so that an item which many documents hold has seeds
all along. Where a document holds seeds of an item, the words around them are aligned with the item: +2 for an equal word, -1 for a
changed, added or missing one. The score is the best local alignment over that of a verbatim copy; from
``THRESHOLD`` on the document is contaminated, which a copy with a third of its words changed still reaches. What is
aligned must also be worth ``EVIDENCE`` equal words, or the whole of a shorter item; from ``LONG`` equal words' worth
on it counts however long the item is, so a large part of a long item is found too. Items of one or two words have no
runs of three and are looked up as whole sequences.

Null or empty items and texts match nothing. Repeated benchmark rows are one item; items that share only the id and
repeated documents each give their rows. Without items the result is empty. Long texts are aligned only around seeds,
but searched whole. The driver holds one slice of the items at a time (``ITEM_BYTES``), whose rows are written before the
next slice is read. Only ids and texts are read; other columns may have any name.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, Words, blocks, table
from tempolith.llm.registry import query

SEED, RARE = 3, 0.001
SAME, OTHER = 2, -1
THRESHOLD, EVIDENCE, LONG = 0.4, 8, 40
#: Bytes of test items that one pass over the documents works on; more items take more passes.
ITEM_BYTES = 32 << 20

_GAP = np.array([not (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) for b in range(256)])


#: Marks and spaces beyond ASCII (Latin-1 signs, general punctuation, CJK and full-width marks), and characters of scripts
#: written without spaces (Thai to Myanmar, Khmer, kana, Han, Yi and the compatibility and supplementary ideographs).
_MARKS = "\u0080-©«-±´¶-¸»¿×÷  -⁯⸀-⹿　-〄〈-〠〰〽・︰-﹯！-／：-＠［-｀｛-･"
_ALONE = "฀-๏຀-໏က-႟ក-៓⺀-⿟々-〇〡-〩ぁ-ヺー-ヿ㐀-䶿一-鿿ꀀ-ꒌ豈-﫿\U00020000-\U0003ffff"
_WIDE, _MARK, _LONE = re.compile(f"[{_MARKS}{_ALONE}]"), re.compile(f"[{_MARKS}]"), re.compile(f"([{_ALONE}])")


def _spaced(text: str) -> str:
    text = text.lower()
    return text if text.isascii() or not _WIDE.search(text) else _LONE.sub(r" \1 ", _MARK.sub(" ", text))


def words_of(texts: list[str | None]) -> Words:
    return Words([_spaced(t or "").encode("utf-8", "replace") for t in texts], _GAP)


class Items:
    """Test items as word hashes, the places of their seeds, and the items of too few words for a seed."""

    def __init__(self, ids: list, texts: list[str | None]):
        w = words_of(texts)
        self.ids = ids
        self.words = [w.hash[w.first[k]:w.first[k + 1]] for k in range(len(ids))]
        grams, at = w.grams(SEED)
        self.gram, self.item, self.place = grams, w.doc[at], at - w.first[w.doc[at]]
        self.grams = np.unique(self.gram)
        #: By number of words: rising hashes of whole items, and the items they belong to.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, SEED):
            held, at = w.grams(n)
            whole = np.flatnonzero(w.count[w.doc[at]] == n)
            whole = whole[np.argsort(held[whole], kind="stable")]
            if len(whole):
                self.short[n] = held[whole], w.doc[at[whole]]

    def choose(self, counts: dict[int, int], documents: int) -> None:
        """Keep the seeds only. ``counts``: documents that hold each run of words."""
        found = np.array([counts.get(g, 0) for g in self.gram.view(np.int64).tolist()], np.int64)
        usual = np.zeros(len(self.ids))
        some = np.flatnonzero(found > 0)
        some = some[np.lexsort((found[some], self.item[some]))]
        if len(some):  # the middle of each item's counts
            item, start, size = np.unique(self.item[some], return_index=True, return_counts=True)
            usual[item] = (found[some][start + (size - 1) // 2] + found[some][start + size // 2]) / 2
        seed = (found > 0) & ((found <= RARE * documents) | (found <= 2 * usual[self.item]))
        by = np.argsort(self.gram[seed], kind="stable")
        self.gram, self.item, self.place = (x[seed][by] for x in (self.gram, self.item, self.place))
        self.grams = np.unique(self.gram)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return np.flatnonzero(known[at] == values) if len(known) else np.empty(0, np.int64)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the place in ``text`` where it ends. Gaps cost 1 a word."""
    steps = np.arange(len(text) + 1)
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(text == word, SAME, OTHER), row[1:] - 1)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def _whole(items: Items, w: Words, block: list[tuple]) -> Iterator[tuple]:
    """First places of items that are too short for seeds."""
    for n, (known, owner) in items.short.items():
        grams, at = w.grams(n)
        hit = _among(grams, known)
        low, high = np.searchsorted(known, grams[hit], "left"), np.searchsorted(known, grams[hit], "right")
        seen: set[tuple[int, int]] = set()
        for k, a, b in zip(hit, low, high):
            d = int(w.doc[at[k]])
            for item in owner[a:b].tolist():
                if (d, item) not in seen:
                    seen.add((d, item))
                    first = int(at[k] - w.first[d])
                    yield block[d][0], items.ids[item], 1.0, first, first + n, n


def matches(items: Items, block: list[tuple]) -> Iterator[tuple]:
    """(doc_id, item_id, score, first_word, last_word, words of the item) of each document and item that share seeds."""
    w = words_of([t for _, t in block])
    yield from _whole(items, w, block)
    grams, at = w.grams(SEED)
    hit = _among(grams, items.grams)
    if not len(hit):
        return
    low, high = np.searchsorted(items.gram, grams[hit], "left"), np.searchsorted(items.gram, grams[hit], "right")
    each = high - low
    row = np.repeat(np.arange(len(hit)), each)
    occurrence = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)
    doc, item = w.doc[at[hit]][row], items.item[occurrence]
    start = at[hit][row] - w.first[doc] - items.place[occurrence]
    order = np.lexsort((start, item, doc))
    doc, item, start = doc[order], item[order], start[order]
    size = np.array([len(x) for x in items.words])[item]
    # seeds of one pair that lie less than an item apart belong to one stretch
    cut = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(start) > size[1:])) + 1
    best: dict[tuple[int, int], tuple] = {}
    for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(doc)]])):
        d, k, n = int(doc[a]), int(item[a]), int(size[a])
        begin, end = max(0, int(start[a]) - n // 2), min(int(w.count[d]), int(start[b - 1]) + n + n // 2)
        if end <= begin:
            continue
        score, last = align(items.words[k], w.hash[w.first[d] + begin:w.first[d] + end])
        value = score / (SAME * n)
        if (d, k) not in best or value > best[d, k][0]:
            best[d, k] = (value, max(begin, begin + last - n), begin + last)
    for (d, k), (value, first, last) in best.items():
        yield block[d][0], items.ids[k], value, first, last, len(items.words[k])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Per document and test item that it holds: doc_id, item_id, score, first_word, last_word (words of the text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((docs, id_col), (benchmark, item_id))]

    def found_in(items: Items) -> DataFrame:
        def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for block in blocks([(i, t or "") for i, t in zip(frame["doc_id"], frame["text"])]):
                    found = [m[:5] for m in matches(items, block) if enough(m, threshold)]
                    yield pd.DataFrame(found, columns=["doc_id", "item_id", "score", "first_word", "last_word"])
        return rows.mapInPandas(find, f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, first_word long, last_word long")

    stage = Scratch(docs.sparkSession, "contaminated")
    count, slices = prepared(docs, benchmark, text_col, item_id, item_text, item_bytes)
    if count == 1:
        return found_in(next(slices))
    return functools.reduce(DataFrame.unionByName, [stage.keep(found_in(items), f"slice{k}") for k, items in enumerate(slices)])


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text holds no test item."""
    out, stage = docs, Scratch(docs.sparkSession, "decontaminated")
    count, slices = prepared(docs, benchmark, text_col, item_id, item_text, item_bytes)
    for k, items in enumerate(slices):
        out = out.filter(_clean(items, threshold)(F.col(text_col)))
        if k + 1 < count:
            out = stage.keep(out, f"slice{k}")
            if k:
                stage.drop(f"slice{k - 1}")
    return out


def _clean(items: Items, threshold: float):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        keep = np.ones(len(texts), bool)
        for block in blocks([(k, t or "") for k, t in enumerate(texts)]):
            keep[[m[0] for m in matches(items, block) if enough(m, threshold)]] = False
        return pd.Series(keep)
    return clean


def enough(match: tuple, threshold: float) -> bool:
    """Whether a match's score will do for its item, or its aligned words will do by themselves."""
    return match[2] >= max(threshold, min(1.0, EVIDENCE / match[5])) or match[2] * match[5] >= LONG


def prepared(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str, item_bytes: int) -> tuple[int, Iterator[Items]]:
    """Test items with their seeds, one slice of bounded size after the other, and the number of slices, which follows
    from a sum over the items."""
    tests = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = int(total // item_bytes) + 1
    texts = docs.select(F.col(text_col).alias("text"))
    return slices, (_slice(texts, tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)) for k in range(slices))


def _slice(texts: DataFrame, tests: DataFrame) -> Items:
    listed = tests.collect()  # bounded: one slice
    items = Items([r["item_id"] for r in listed], [r["text"] for r in listed])
    known = items.grams

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(len(known), np.int64)
        documents = 0
        for frame in frames:
            for block in blocks([(None, t or "") for t in frame["text"]]):
                documents += len(block)
                w = words_of([t for _, t in block])
                grams, at = w.grams(SEED)
                hit = _among(grams, known)
                pair = np.unique(w.doc[at[hit]] * max(1, len(known)) + np.searchsorted(known, grams[hit]))
                seen += np.bincount(pair % max(1, len(known)), minlength=len(known))[:len(known)]
        some = np.flatnonzero(seen)
        yield pd.DataFrame({"gram": known[some].view(np.int64), "n": seen[some], "documents": False})
        yield pd.DataFrame({"gram": [0], "n": [documents], "documents": True})

    sums = texts.mapInPandas(count, "gram long, n long, documents boolean").groupBy("documents", "gram").agg(F.sum("n").alias("n")).collect()
    items.choose({r["gram"]: r["n"] for r in sums if not r["documents"]}, sum(r["n"] for r in sums if r["documents"]))
    return items


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
