"""Ranked lexical search: best-first document intervals, bounded by range maxima of posting lists.

Three steps, each a Spark job over whole tables:

1. Index. A task cuts its documents into blocks of at most ``BLOCK_BYTES`` of text (one document at least) and writes,
   for each block, its documents with their lengths and one row for each term with its postings. Numbers of documents
   and terms, and the documents that hold each query term, are sums over these rows.
2. Search. The postings of the query terms meet their block's documents and a slice of the queries, one group for each
   block and slice. In a group each posting list is an array of impacts by document, with a sparse table over it that
   gives the largest impact in any range in two look-ups. A query's search starts from the interval of all documents of
   the block; the sum of its terms' range maxima bounds every score in an interval. The intervals with the largest
   bounds are taken first, a batch at a time: the document with the largest single impact is scored exactly, and what
   is left and right of it become new intervals. Those whose bound can't beat the k best found so far go; the search
   ends when none is left, so the k best of a block are exact.
3. The k best of all blocks are ranked, by a window that keeps k rows of a query in each task before it shuffles.

Blocks bound what a group holds, whatever word or text is common; the queries meet every block in slices of about
``SLICE`` queries, and no document is left out. All stage tables are written to the shared folder.

Terms are runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased. A null text has no terms, and a
document without terms is counted nowhere and never found. Equal scores go by ascending id, null ids last. Repeated
document rows are ranked one by one; equal query rows (same id, same text) count as one query, and those that share
only the id are ranked by themselves. An empty table on either side gives an empty result. Columns other than ids and
texts are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolith.llm.common import LOWER, UPPER, Scratch, table
from tempolith.llm.registry import query

#: Bytes of text of a block, queries of a slice, intervals that a search takes at a time, index rows of a batch.
BLOCK_BYTES, SLICE, BATCH, INDEX_ROWS = 24 << 20, 1000, 64, 50_000
_NO_ID = np.iinfo(np.int64).max

_GAPS = bytes(c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123))
_CUT = bytes.maketrans(_GAPS + UPPER.encode(), b" " * len(_GAPS) + LOWER.encode())


# ---------------------------------------------------------------- index
def _binary(flat: np.ndarray, start: np.ndarray) -> pa.Array:
    """Slices of an int32 array as one binary value each."""
    first = int(start[0])
    offsets = ((start - first) * 4).astype(np.int32)
    data = np.ascontiguousarray(flat[first:int(start[-1])], np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _block(block: int, ids: list, found: list[np.ndarray], terms: list[bytes]) -> Iterator[pa.RecordBatch]:
    """A row with the block's documents in the order of their ids, then a row for each term."""
    key = np.array([_NO_ID if i is None else i for i in ids], np.int64)
    place = np.argsort(key, kind="stable")
    sizes = np.array([len(t) for t in found], np.int64)[place]
    rows = len(ids)
    doc = np.repeat(np.arange(rows, dtype=np.int64), sizes)
    pairs = np.concatenate([found[k] for k in place]).astype(np.int64) * rows + doc if sizes.sum() else np.empty(0, np.int64)
    pairs, tf = np.unique(pairs, return_counts=True)
    start = np.searchsorted(pairs, np.arange(len(terms) + 1, dtype=np.int64) * rows)
    flat = (pairs % max(rows, 1)).astype(np.int32)
    nulls = [pa.nulls(1, t) for t in (pa.binary(), pa.int64(), pa.binary(), pa.binary())]
    yield pa.RecordBatch.from_arrays([pa.array([block]), *nulls, pa.array([key[place].tobytes()], pa.binary()),
                                      pa.array([sizes.tobytes()], pa.binary()), pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())])], names=_INDEX_NAMES)
    for at in range(0, len(terms), INDEX_ROWS):
        cut = start[at:at + INDEX_ROWS + 1]
        m = len(cut) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, block, np.int64)), pa.array(terms[at:at + m], pa.binary()), pa.array(np.diff(cut)), _binary(flat, cut),
             _binary(tf, cut), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=_INDEX_NAMES)


_INDEX = "block long, term binary, df long, docs binary, tfs binary, ids binary, sizes binary, n_docs long, n_terms long"
_INDEX_NAMES = [c.split()[0] for c in _INDEX.split(", ")]


def _index_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyspark

    block = pyspark.TaskContext.get().partitionId() << 32
    ids, found, held, names = [], [], 0, defaultdict(count().__next__)
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (text.as_py() or b"").translate(_CUT)
            if ids and held + len(words) > BLOCK_BYTES:
                yield from _block(block, ids, found, list(names))
                block, ids, found, held, names = block + 1, [], [], 0, defaultdict(count().__next__)
            words, held = words.split(), held + len(words)
            ids.append(i)
            found.append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
    if ids:
        yield from _block(block, ids, found, list(names))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each block's documents (ids, sizes, n_docs, n_terms) and one for each of its terms (term, df, docs, tfs)."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(_index_task, _INDEX)


# ---------------------------------------------------------------- search in a block
class Postings:
    """Posting lists of a block, end to end, with the place of the largest impact of every power-of-two range."""

    def __init__(self, docs: list[np.ndarray], impacts: list[np.ndarray], rows: int):
        self.rows = rows
        self.start = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        self.doc = np.concatenate(docs).astype(np.int64)
        self.impact = np.concatenate(impacts).astype(np.int64)
        #: (list, document) as one rising number, for searches in all lists at once.
        self.key = self.doc + np.repeat(np.arange(len(docs), dtype=np.int64) * rows, np.diff(self.start))
        levels = [np.arange(len(self.doc), dtype=np.int32)]
        for k in range(int(np.diff(self.start).max()).bit_length() - 1):
            low = levels[-1]
            high = np.concatenate([low[1 << k:], low[len(low) - (1 << k):]])
            levels.append(np.where(self.impact[high] > self.impact[low], high, low))
        self.top = np.array(levels)

    def largest(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and impact of the largest of places a .. b - 1; impact 0 where there are none."""
        some = b > a
        k = np.frexp(np.where(some, b - a, 1).astype(np.float64))[1] - 1
        left = self.top[k, np.where(some, a, 0)]
        right = self.top[k, np.where(some, b - (1 << k), 0)]
        at = np.where(self.impact[right] > self.impact[left], right, left)
        return at, np.where(some, self.impact[at], 0)


def best(post: Postings, ids: np.ndarray, lists: np.ndarray, weight: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(document, score) of the k best of a block for one query, best first. Documents are in the order of their ids.

    ``lists`` are the query's posting lists, ``weight`` what an impact there is worth. Frontier rows are intervals of
    documents with the places of each list that fall in them.
    """
    base = lists * post.rows
    low, high = np.zeros(1, np.int64), np.full(1, post.rows, np.int64)
    a, b = post.start[lists][None, :], post.start[lists + 1][None, :]
    at, value = post.largest(a, b)
    value = value * weight
    bound = value.sum(axis=1)
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    floor, last = 1, post.rows  # the k-th best so far: a score, and the document that has it
    while len(low):
        take = np.argpartition(-bound, BATCH - 1)[:BATCH] if len(bound) > BATCH else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[take] = False
        # each of these is split at the document with its largest single impact, which is scored
        mid = post.doc[np.take_along_axis(at[take], value[take].argmax(axis=1)[:, None], 1)[:, 0]]
        place = np.searchsorted(post.key, base + mid[:, None])
        safe = np.minimum(place, len(post.key) - 1)
        here = (post.key[safe] == base + mid[:, None])
        docs = np.concatenate([docs, mid])
        scores = np.concatenate([scores, (np.where(here, post.impact[safe], 0) * weight).sum(axis=1)])
        if len(scores) > k:
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
        if len(scores) == k:
            worst = np.lexsort((docs, -scores))[-1]
            floor, last = max(int(scores[worst]), 1), int(docs[worst])
        new_low, new_high = np.concatenate([low[take], mid + 1]), np.concatenate([mid, high[take]])
        new_a, new_b = np.concatenate([a[take], place + here]), np.concatenate([place, b[take]])
        new_at, new_value = post.largest(new_a, new_b)
        new_value = new_value * weight
        new_bound = new_value.sum(axis=1)
        low, high, bound = (np.concatenate([o[rest], n]) for o, n in ((low, new_low), (high, new_high), (bound, new_bound)))
        a, b, at, value = (np.concatenate([o[rest], n]) for o, n in ((a, new_a), (b, new_b), (at, new_at), (value, new_value)))
        live = (low < high) & ((bound > floor) | ((bound == floor) & (low <= last)))
        low, high, bound, a, b, at, value = (x[live] for x in (low, high, bound, a, b, at, value))
    order = np.lexsort((docs, -scores))
    return [(int(docs[i]), int(scores[i])) for i in order if scores[i] > 0]


_FOUND = "query long, doc_id long, score long"


def _search(k: int, n_docs: int, n_terms: int):
    """Search of a group: the postings of a slice's terms in a block, and the block's documents with the slice's queries."""
    def of_group(postings: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if postings.num_rows and block.num_rows:
            ids = np.frombuffer(block.column("ids")[0].as_py(), np.int64)
            m = 75 + (25 * np.frombuffer(block.column("sizes")[0].as_py(), np.int64) * n_docs) // n_terms
            terms = {t: i for i, t in enumerate(postings.column("term").to_pylist())}
            docs = [np.frombuffer(x.as_py(), np.int32) for x in postings.column("docs")]
            tfs = [np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in postings.column("tfs")]
            post = Postings(docs, [10**9 * tf // (1000 * tf + 12 * m[d]) for d, tf in zip(docs, tfs)], len(ids))
            weight = postings.column("weight").to_numpy()
            queries: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for q in block.column("queries")[0].as_py():
                if q["term"] in terms:
                    queries[q["query"]].append((terms[q["term"]], q["times"]))
            for q, held in queries.items():
                lists = np.array([t for t, _ in held], np.int64)
                for doc, score in best(post, ids, lists, weight[lists] * np.array([n for _, n in held], np.int64), k):
                    out.append((q, None if ids[doc] == _NO_ID else int(ids[doc]), score))
        columns = list(zip(*out)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    return of_group


# ---------------------------------------------------------------- operator
def _terms(items: DataFrame, id_col: str, text_col: str, stage: Scratch) -> DataFrame:
    """(query, slice, item id, term, times): queries numbered once in a written table, terms as bytes."""
    from tempolith.llm.licenses import GAP

    each = stage.keep(items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).distinct()
                      .withColumn("query", F.monotonically_increasing_id()), "queries")
    slices = max(1, -(-each.count() // SLICE))
    lower = F.translate(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), GAP, " ")), UPPER, LOWER)
    return (each.select("query", "item", F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int").alias("slice"), F.explode(F.split(lower, " ")).alias("term"))
            .filter("term <> ''").groupBy("query", "item", "slice", F.col("term").cast("binary").alias("term")).agg(F.count(F.lit(1)).cast("int").alias("times")))


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of every query row: (item id, rank, doc_id, score), scores above 0 only."""
    spark = docs.sparkSession
    stage = Scratch(spark, "search")
    index = stage.keep(build_index(docs, doc_id, doc_text), "index")
    asked = stage.keep(_terms(items, item_id, item_text, stage), "terms")
    heads = index.filter("term IS NULL")
    total = heads.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n, size = int(total.n or 0), int(total.l or 0)
    terms = index.filter("term IS NOT NULL")
    wanted = asked.select("term").distinct()
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = stage.keep(terms.select("term", "df").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
                         .select("term", weight.alias("weight")), "weights")
    by_slice = asked.select("slice", "term").distinct().join(weights, "term")
    postings = terms.select("block", "term", "docs", "tfs").join(by_slice, "term")
    slices = asked.groupBy("slice").agg(F.collect_list(F.struct("query", "term", "times")).alias("queries"))
    numbers = [r.slice for r in slices.select("slice").collect()]
    blocks = (heads.select(F.col("block").alias("of"), "ids", "sizes", F.explode(F.array(*map(F.lit, numbers)).cast("array<int>")).alias("slice"))
              .join(slices, "slice").withColumnRenamed("slice", "part"))
    found = (postings.groupBy("block", "slice").cogroup(blocks.groupBy("of", "part")).applyInArrow(_search(k, n, max(size, 1)), _FOUND))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = asked.select("query", F.col("item").alias(item_id)).distinct()
    result = stage.keep(ranked.join(named, "query").select(item_id, "rank", "doc_id", "score"), "result")
    stage.drop("index", "queries", "terms", "weights")
    return result


@query("op13_search", r"""
    WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
    g AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS all_docs, sum(len(words))::BIGINT AS all_terms FROM t),
    i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM benchmark),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(words) AS term FROM i) GROUP BY ALL),
    p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM t)
          WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term),
    s AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms))))::BIGINT AS score
          FROM q JOIN p USING (term) JOIN w USING (term), g GROUP BY ALL)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0
    QUALIFY rank <= 20""")
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
