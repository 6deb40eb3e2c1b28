"""MinHash near-dedup: universal hash minima, banding, verification, connected components.

Texts are cut into words (A-Z lower-cased, ASCII white space between them); a document's set holds its distinct
five-word shingles, or its whole word sequence where that is shorter. Documents whose sets have a Jaccard
similarity of at least 0.75 are linked; links make components.

* Documents with the same set are one representative from the start, so exact copies cost one row.
* 128 minima in 32 bands of 4: a link at exactly 0.75 shares no band with a chance of 5 in a million.
* Every bucket links its members to its smallest member, the links are confirmed on the full sets, and the
  components found so far close most buckets. In the rest, members are linked in small random stars, other ones in
  every band, which joins what is similar throughout. Only buckets that even then hold several components are
  compared member by member, in tiles of bounded size that many tasks share: signatures there decide which pairs
  of different components are worth a full comparison. No bucket is capped and no link is left out.
* Components by alternating large-star and small-star (``components``).

Defined results: a null or empty text, or one of white space only, has an empty set, links with nothing, and
is its own component. A null id has no links and a null component. Rows with one id are one node, whatever their texts. Ties and
repeated rows fall into one component. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, Words, blocks, mix, numbered, table
from tempolith.llm.components import components
from tempolith.llm.registry import query

SHINGLE = 5
ROWS, BANDS = 4, 32
MINIMA = ROWS * BANDS
#: Members of a small star in a bucket that is open after the first round, about.
STAR = 8
#: Members of a tile's side where a bucket is compared member by member.
TILE = 1024
#: Minima that must agree before sets are compared in a tile: 0.75 less 4.5 standard deviations.
AGREE = int(MINIMA * (0.75 - 4.5 * (0.75 * 0.25 / MINIMA) ** 0.5))

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_A = mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, MINIMA + 1001, dtype=np.uint64))
_BAND = mix(np.arange(2001, BANDS + 2001, dtype=np.uint64))


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's set starts."""
    words = Words([t.translate(_FOLD) for t in texts])
    hashes, at = words.grams(n)
    doc = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            more = words.count[short] > k
            whole[more] = mix(whole[more] + words.hash[words.first[short[more]] + k])
        hashes = np.concatenate([hashes, mix(whole + words.count[short].astype(np.uint64))])
        doc = np.concatenate([doc, short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])])
        hashes, doc = hashes[new], doc[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minima of the universal hash functions over each set that is not empty: one row of 32-bit values each."""
    starts = first[:-1][first[1:] > first[:-1]]
    out = np.empty((MINIMA, len(starts)), np.uint32)
    held = np.empty_like(hashes)
    for k in range(MINIMA):
        np.multiply(hashes, _A[k], out=held)
        np.add(held, _B[k], out=held)
        out[k] = np.minimum.reduceat(held, starts) >> np.uint64(32)
    return np.ascontiguousarray(out.T)


def _profiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for block in blocks([(i, bytes(t)) for i, t in zip(frame["doc_id"], frame["raw"])]):
            hashes, first = shingle_sets([t for _, t in block])
            n = np.diff(first)
            some = n > 0
            marks, sigs = np.zeros((2, len(block)), np.uint64), [b""] * len(block)
            if some.any():
                starts = first[:-1][some]
                marks[0, some] = np.add.reduceat(mix(hashes), starts)
                marks[1, some] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
                rows = signatures(hashes, first)
                for k, at in enumerate(np.flatnonzero(some)):
                    sigs[at] = rows[k].tobytes()
            yield pd.DataFrame({"doc_id": [i for i, _ in block], "n": n, "m1": marks[0].view(np.int64), "m2": marks[1].view(np.int64), "sig": sigs})


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A key for each band of each signature. Keys of different bands never meet, as the band is mixed in."""
    halves = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS // 2)
    key = np.broadcast_to(_BAND, (len(sig), BANDS)).copy()
    for k in range(ROWS // 2):
        key = mix(key + halves[:, :, k])
    return key.view(np.int64)


def _unpack(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint32).reshape(len(column), MINIMA)


def _bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            yield pd.DataFrame({"key": band_keys(_unpack(frame["sig"])).ravel(), "id": np.repeat(frame["doc_id"].to_numpy(), BANDS)})


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            left, right = [], []
            pairs = list(zip(frame["u"], frame["v"], map(bytes, frame["tu"]), map(bytes, frame["tv"])))
            for block in blocks([(p, p[2] + p[3]) for p in pairs]):
                texts = {t: None for p, _ in block for t in p[2:]}
                hashes, first = shingle_sets(list(texts))
                sets = {t: hashes[first[k]:first[k + 1]] for k, t in enumerate(texts)}
                for (u, v, tu, tv), _ in block:
                    if _similar(sets[tu], sets[tv], percent):
                        left.append(u)
                        right.append(v)
            yield pd.DataFrame({"u": left, "v": right})
    return work


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for block in blocks([(i, bytes(t)) for i, t in zip(frame["doc_id"], frame["raw"])]):
            hashes, first = shingle_sets([t for _, t in block])
            some = np.flatnonzero(np.diff(first))
            sigs = signatures(hashes, first)
            yield pd.DataFrame({"id": [block[k][0] for k in some], "sig": [s.tobytes() for s in sigs],
                                "shingles": [hashes[first[k]:first[k + 1]].tobytes() for k in some]})


def _tile(percent: int):
    def work(frame: pd.DataFrame) -> pd.DataFrame:
        """Links across a tile of a bucket between different components.

        Signatures choose the pairs whose sets are compared, each pair only in the first band that it shares.
        """
        a, b = (frame[frame["side"] == s] for s in (0, 1))
        links = []
        if len(a) and len(b):
            sa, sb = _unpack(a["sig"]), _unpack(b["sig"])
            ka, kb = band_keys(sa), band_keys(sb)
            key = frame["key"].iloc[0]
            band = int(np.flatnonzero((ka == key).any(axis=0))[0]) if (ka == key).any() else 0
            # an id may stand here for several texts, of which some are not in this bucket
            a, b = a[ka[:, band] == key], b[kb[:, band] == key]
            sa, sb, ka, kb = sa[ka[:, band] == key], sb[kb[:, band] == key], ka[ka[:, band] == key], kb[kb[:, band] == key]
            ia, ib, ca, cb = a["id"].to_numpy(), b["id"].to_numpy(), a["component"].to_numpy(), b["component"].to_numpy()
            wa, wb = ([np.frombuffer(bytes(x), np.uint64) for x in side["shingles"]] for side in (a, b))
            for k in range(len(a)):
                near = np.flatnonzero((cb != ca[k]) & ((sb == sa[k]).sum(axis=1) >= AGREE))
                near = near[(kb[near, :band] != ka[k, :band]).all(axis=1)]
                links += [(min(ia[k], ib[j]), max(ia[k], ib[j])) for j in near if _similar(wa[k], wb[j], percent)]
        return pd.DataFrame(links, columns=["u", "v"]).astype("int64")
    return work


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Ids are long integers; ``percent`` is at least 75, for which the bands are made."""
    if percent < 75:
        raise ValueError("the bands find links from 75 percent on")
    spark = docs.sparkSession
    stage = Scratch(spark, "minhash")
    raw = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("raw"))
    known = raw.filter("doc_id IS NOT NULL")
    profiles = stage.keep(known.mapInPandas(_profiles, "doc_id long, n long, m1 long, m2 long, sig binary"), "profiles")

    # equal sets: one representative
    sets = profiles.filter("n > 0").groupBy("n", "m1", "m2").agg(F.min("doc_id").alias("rep"))
    members = stage.keep(profiles.select("doc_id", "n", "m1", "m2").join(sets, ["n", "m1", "m2"], "left")
                         .select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "members")
    reps = profiles.filter("n > 0").join(sets.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")

    # rows with one id and different sets: their representatives are one node
    same_id = members.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).filter("u < v").select("doc_id", "u")
    same_id = members.select("doc_id", "rep").join(same_id, "doc_id").filter("rep <> u").select("u", F.col("rep").alias("v")).distinct()

    # buckets with several members, each row with the bucket's smallest member
    hits = reps.select("doc_id", "sig").mapInPandas(_bands, "key long, id long")
    full = hits.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("other"), F.count(F.lit(1)).alias("size")).filter("centre < other").drop("other")
    hits = stage.keep(hits.join(full, "key"), "hits")
    texts = stage.keep(known.join(hits.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts")

    def confirmed(pairs: DataFrame, step: str) -> DataFrame:
        with_left = pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("raw").alias("tu")), "u")
        with_both = with_left.join(texts.select(F.col("doc_id").alias("v"), F.col("raw").alias("tv")), "v")
        return stage.keep(with_both.select("u", "v", "tu", "tv").mapInPandas(_confirm(percent), "u long, v long"), step)

    stars = hits.filter("id <> centre").select(F.col("centre").alias("u"), F.col("id").alias("v")).distinct()
    links = confirmed(stars, "stars").unionByName(stage.keep(same_id, "same_id"))
    found = components(links, stage, "first")

    def still_open(found: DataFrame) -> DataFrame:
        """Members of buckets that hold several components yet, with their component and the bucket's size."""
        placed = hits.filter("size > 2").join(found, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"))
        return placed.join(mixed.filter("low < high").select("key", "size"), "key")

    # random small stars inside the open buckets: with other partners in every band, similar members find each other
    small = stage.keep(still_open(found).withColumn("part", F.pmod(F.xxhash64("id", "key"), F.ceil(F.col("size") / STAR))), "small")
    heads = small.groupBy("key", "part").agg(F.min("id").alias("u"))
    again = small.join(heads, ["key", "part"]).join(found.select(F.col("node").alias("u"), F.col("component").alias("other")), "u", "left")
    again = again.filter((F.col("id") != F.col("u")) & (F.col("component") != F.coalesce("other", "u"))).select("u", F.col("id").alias("v")).distinct()
    links = links.unionByName(confirmed(again.join(stars, ["u", "v"], "left_anti"), "again"))
    found = components(links, stage, "second")

    # what is open still: every pair across components gets its chance
    open_ = still_open(found).withColumn("tiles", F.ceil(F.col("size") / TILE)).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("tiles"))).drop("size")
    open_ = stage.keep(open_, "open")
    sides = open_.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    one, two = F.least("mine", "other"), F.greatest("mine", "other")
    sides = sides.select("key", "id", "component", one.alias("t1"), two.alias("t2"), F.when(F.col("mine") == F.col("other"), F.array(F.lit(0), F.lit(1)))
                         .otherwise(F.array(F.when(F.col("mine") < F.col("other"), 0).otherwise(1))).alias("in"))
    sides = sides.withColumn("side", F.explode("in")).drop("in")
    members_of = open_.select(F.col("id").alias("doc_id")).distinct()
    signed = (texts.join(members_of, "doc_id", "left_semi").mapInPandas(_sets, "id long, sig binary, shingles binary")
              .groupBy("id", "sig").agg(F.first("shingles").alias("shingles")))
    sides = sides.join(stage.keep(signed, "signed"), "id")
    more = stage.keep(sides.groupBy("key", "t1", "t2").applyInPandas(_tile(percent), "u long, v long").distinct(), "more")
    nodes = components(links.unionByName(more), stage, "third")

    done = members.join(nodes, F.col("rep") == F.col("node"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    done = stage.keep(done, "result")
    stage.drop(*[s for s in stage.paths if s != "result"])
    unknown = raw.filter("doc_id IS NULL").mapInPandas(_profiles, "doc_id long, n long, m1 long, m2 long, sig binary")
    unknown = unknown.select(F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return done.unionByName(unknown).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with their columns, that stand for their component: one row of each id that is kept.

    Rows without an id have no links, so all of them stay.
    """
    kept = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__id")).distinct()
    rows = docs.filter(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col("__id"), "left_semi")
    rows = numbered(rows, id_col, F.md5(F.coalesce(F.col(text_col), F.lit("")))).filter("__occ = 1").drop("__occ")
    return rows.unionByName(docs.filter(F.col(id_col).isNull()))


@query("op1_minhash", """
    WITH RECURSIVE t AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
    n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * both_ >= 75 * (nx.c + ny.c - both_)),
    r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reach),
    m AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.c, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
    FROM documents d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
