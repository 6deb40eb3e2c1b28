import hashlib
import random
from collections import Counter

from tempolith.llm.suffix_dedup import LENGTH, repeated_spans
from tests.llm.helpers import awkward, frame, words


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + LENGTH] for b in raw for k in range(len(b) - LENGTH + 1))
    out = []
    for b in raw:
        hit = [False] * len(b)
        for k in range(len(b) - LENGTH + 1):
            if seen[b[k:k + LENGTH]] > 1:
                hit[k:k + LENGTH] = [True] * LENGTH
        runs = [(k, next((e for e in range(k, len(b)) if not hit[e]), len(b))) for k in range(len(b)) if hit[k] and (k == 0 or not hit[k - 1])]
        out.append((len(b), runs, hashlib.sha256(bytes(x for x, h in zip(b, hit) if not h)).hexdigest()))
    return out


def corpus():
    r = random.Random(7)
    passages = [" ".join(words(r, n)) for n in (45, 60, 120)] + ["ab" * 150, "é" * 140, "x" * 230]
    rows = [x for x in awkward() if x[0] not in (9,)]
    for k in range(60):
        parts = [" ".join(words(r, r.randrange(1, 50))) for _ in range(3)]
        for p in r.sample(passages, 2):
            a, b = sorted(r.randrange(len(p) + 1) for _ in range(2))
            parts.insert(r.randrange(4), p if r.random() < 0.5 else p[a:b])
        rows.append((7000 + k, r.choice([" ", "\n", ""]).join(parts), "en", "a", 0))
    rows += [(7100, rows[-1][1], "en", "a", 0), (7101, rows[-3][1], "en", "b", 0)]
    long = rows[-10][1]
    rows.append((7102, long[:250] + "Z" + long[251:], "en", "a", 0))   # one byte changed
    rows.append((7103, "q" * 199, "en", "a", 0))
    rows.append((7104, "q" * 199, "en", "a", 0))
    rows.append((7105, "yz" * 1500, "en", "a", 0))
    return rows


def test_repeated_spans_against_brute_force(spark):
    rows = corpus()
    got = repeated_spans(frame(spark, rows, clash=True)).collect()
    want = sorted(((i, *b) for (i, *_), b in zip(rows, brute([t for _, t, *_ in rows]))), key=str)
    assert sorted(((x.doc_id, x.n_bytes, [(s.start, s.end) for s in x.spans], x.kept_sha256) for x in got), key=str) == want


def test_nothing_and_short_texts(spark):
    assert repeated_spans(frame(spark, [])).count() == 0
    got = repeated_spans(frame(spark, [(1, "short", None, None, None), (2, "short", None, None, None)])).collect()
    assert all(x.spans == [] for x in got)


def test_texts_of_more_than_a_block(spark):
    """Two texts over 1 MB that share passages with each other, with short texts and within themselves, across block borders too."""
    from tempolith.llm.common import BLOCK
    r = random.Random(31)
    pieces = ["".join(r.choices("abcdefghij klmn", k=n)) for n in (200, 201, 350, 5000)]
    long = "".join(r.choices("abcdefghijklmnop qrst", k=BLOCK + 40_000))
    other = "".join(r.choices("abcdefghijklmnop qrst", k=BLOCK + 300_000))
    for at, piece in ((0, 3), (BLOCK - 100, 2), (BLOCK + 20_000, 0)):
        long = long[:at] + pieces[piece] + long[at:]
    for at, piece in ((500_000, 3), (BLOCK - 2_000, 3), (BLOCK + 200_000, 1)):
        other = other[:at] + pieces[piece] + other[at:]
    rows = [(1, long, "en", "a", 0), (2, other, "en", "a", 0), (3, "start " + pieces[0] + " end", "en", "a", 0), (4, pieces[2][:340], "en", "a", 0), (5, pieces[1][1:], "en", "a", 0)]
    got = sorted((x.doc_id, x.n_bytes, [(s.start, s.end) for s in x.spans], x.kept_sha256) for x in repeated_spans(frame(spark, rows)).collect())
    raw = [t.encode() for _, t, *_ in rows]
    seen = Counter(hash(b[k:k + LENGTH]) for b in raw for k in range(len(b) - LENGTH + 1))
    want = []
    for (i, *_), b in zip(rows, raw):
        starts = [k for k in range(len(b) - LENGTH + 1) if seen[hash(b[k:k + LENGTH])] > 1]
        spans: list[list[int]] = []
        for k in starts:
            if spans and k <= spans[-1][1]:
                spans[-1][1] = k + LENGTH
            else:
                spans.append([k, k + LENGTH])
        kept = b"".join(b[a:e] for a, e in zip([0, *(e for _, e in spans)], [*(a for a, _ in spans), len(b)]))
        want.append((i, len(b), [tuple(x) for x in spans], hashlib.sha256(kept).hexdigest()))
    assert got == want and sum(len(w[2]) for w in want) >= 8
