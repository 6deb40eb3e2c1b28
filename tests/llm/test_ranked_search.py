import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

import tempolith.llm.ranked_search as ranked
from tempolith.llm.ranked_search import search
from tests.llm.helpers import CLASH, awkward, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _plain(docs, items, k=20):
    held = [(i, Counter(_terms(t)), len(_terms(t))) for i, t, *_ in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for i, c, n in held:
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 0
            s = sum(q * w[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in Counter(_terms(text)).items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i if i is not None else 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def _docs():
    r = random.Random(7)
    pool = [f"w{k}" for k in range(300)]
    common = lambda n: " ".join(r.choices(pool, [1 / (k + 1) for k in range(300)], k=n))
    rows = awkward() + [(200 + k, common(r.randrange(1, 120)), "en", "a", None) for k in range(400)]
    rows += [(2000 + k, "One copy, of w1 w2 W3!", None, None, None) for k in range(60)]  # ties
    return rows + [(5000, common(20000), None, None, None), (5001, "\x00w1\x7fw2é ÉW3", None, None, None)]


def _items():
    r = random.Random(8)
    own = [(k, " ".join(f"w{int(300 * r.random() ** 3)}" for _ in range(r.randrange(1, 30)))) for k in range(40)]
    return own + [(100, "one copy of w1 w2 w3"), (101, None), (102, ""), (103, "nowhere found"), (0, "the same id w5 w6"), (104, "w1 w1 w1 W2"), (104, "w1 w1 w1 W2"),
                  (None, "w7 w9"), (105, " ".join(f"w{k}" for k in range(300)))]


def _run(spark, docs, items, parts=4, **more):
    asked = spark.createDataFrame(items, "item_id long, text string")
    asked = asked.withColumns({c: F.lit(v) if v is not None else F.lit(None).cast("int") for c, v in (CLASH | {"query": 1, "term": 2, "slice": 3, "block": 4}).items()})
    found = search(frame(spark, docs, clash=True).repartition(parts), asked, **more)
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_search_against_all_scores(spark, monkeypatch):
    docs, items = _docs(), _items()
    want = _plain(docs, items)
    got = _run(spark, docs, items)
    assert got == want
    assert _run(spark, docs, items, parts=1, k=3) == _plain(docs, items, 3)
    monkeypatch.setattr(ranked, "SLICE", 7)
    assert _run(spark, docs, items, parts=9) == want


def test_blocks_and_batches_of_any_size_agree():
    docs, items = _docs(), _items()
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, *_ in docs], pa.int64()), pa.array([(t or "").encode() for _, t, *_ in docs])], names=["i", "t"])
    rows = [r for b in ranked._block(0, batch.column(0).to_pylist(), *_cut(batch)) for r in b.to_pylist()]
    head, terms = rows[0], rows[1:]
    assert head["n_docs"] == sum(bool(_terms(t)) for _, t, *_ in docs) and head["n_terms"] == sum(len(_terms(t)) for _, t, *_ in docs)
    df = Counter(t for _, x, *_ in docs for t in set(_terms(x)))
    assert {r["term"].decode(): r["df"] for r in terms} == df
    lists = [np.frombuffer(r["docs"], np.int32) for r in terms]
    impacts = [np.frombuffer(r["tfs"], np.int32).astype(np.int64) for r in terms]
    post = ranked.Postings(lists, impacts, len(docs))
    a, b = post.start[:-1], post.start[1:]
    assert post.largest(a, b)[1].tolist() == [int(x.max()) for x in impacts]
    ids = np.frombuffer(head["ids"], np.int64)
    for _, text in items:
        own = np.array([k for k, r in enumerate(terms) if r["term"].decode() in set(_terms(text))], np.int64)
        if not len(own):
            continue
        scores = np.zeros(len(docs), np.int64)
        for k in own:
            scores[lists[k]] += 3 * impacts[k]
        want = sorted(((-s, d) for d, s in enumerate(scores) if s > 0))[:20]
        for size in (1, 5, 64):
            ranked.BATCH, before = size, ranked.BATCH
            assert ranked.best(post, ids, own, np.full(len(own), 3), 20) == [(d, -s) for s, d in want]
            ranked.BATCH = before


def _cut(batch):
    import numpy as np

    names, found = {}, []
    for t in batch.column(1).to_pylist():
        found.append(np.array([names.setdefault(w, len(names)) for w in t.translate(ranked._CUT).split()], np.int32))
    return found, list(names)


def test_empty_tables(spark):
    assert _run(spark, [], _items()) == [] == _run(spark, _docs(), [])
    assert _run(spark, [(1, None, None, None, None), (2, "  ", None, None, None)], _items()) == []
