import random

import pytest

from tempolith.llm import minhash
from tempolith.llm.common import LOWER, UPPER, Scratch
from tempolith.llm.components import components
from tests.llm.helpers import awkward, frame, words

FOLD = str.maketrans(UPPER, LOWER)


def shingles(text):
    w = (text or "").translate(FOLD).split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return sorted((i, len(s), find(i), i == find(i)) for i, s in sets)


def near_group(r, n, start, changes):
    """Copies of one text with a few words changed in each: similar in pairs, to various degrees."""
    base = words(r, 80)
    out = []
    for k in range(n):
        w = list(base)
        for at in r.sample(range(80), r.randrange(changes + 1)):
            w[at] = f"x{r.randrange(9)}"
        out.append((start + k, " ".join(w), "en", "a", 0))
    return out


@pytest.mark.parametrize("tile,star", [(1024, 8), (5, 2)])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, tile, star):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "STAR", star)
    r = random.Random(3)
    rows = awkward() + near_group(r, 60, 3000, 4) + near_group(r, 40, 4000, 2) + [(6000 + k, "same text in short", "en", "a", 0) for k in range(20)]
    got = minhash.near_duplicates(frame(spark, rows, clash=True)).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got if x.doc_id is not None) == brute(rows)
    assert sorted(x.n_shingles for x in got if x.doc_id is None) == [0, 1]


def test_long_words_that_a_polynomial_cannot_tell_apart(spark):
    morse = "a"
    while len(morse) < 2048:
        morse += morse.translate(str.maketrans("ab", "ba"))
    rows = [(1, morse, "en", "a", 0), (2, morse.translate(str.maketrans("ab", "ba")), "en", "a", 0), (3, morse + " one two three four five six", "en", "a", 0),
            (4, morse.translate(str.maketrans("ab", "ba")) + " one two three four five six", "en", "a", 0), (5, morse, "en", "a", 0)]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got) == brute(rows)


@pytest.mark.parametrize("tile,star", [(1024, 8), (4, 2)])
def test_one_id_with_several_texts_is_one_node(spark, monkeypatch, tile, star):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "STAR", star)
    r = random.Random(13)
    near, other = near_group(r, 50, 3000, 8), near_group(r, 30, 5000, 8)
    rows = near + other + [(3, "text a", "en", "a", 0), (7, "text a", "en", "a", 0), (7, "text b", "en", "a", 0), (5, "text b", "en", "a", 0), (8, None, "en", "a", 0), (8, "text b", "en", "a", 0)]
    rows += [(near[k][0], other[k][1], "en", "a", 0) for k in (4, 9)] + [(near[1][0], near[2][1], "en", "a", 0), (near[1][0], near[1][1], "en", "a", 0)]
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: c for i, _, c, _ in brute(rows)}


def test_links_below_the_bands_are_refused(spark):
    with pytest.raises(ValueError):
        minhash.near_duplicates(frame(spark, []), percent=50)


def test_deduplicated_keeps_one_row_of_each_component(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True)
    out = minhash.deduplicated(docs)
    assert out.columns == docs.columns
    want = sorted({c for i, _, c, _ in brute(rows)})
    assert sorted(x.doc_id for x in out.collect() if x.doc_id is not None) == want
    assert out.filter("doc_id IS NULL").count() == 2
    assert minhash.deduplicated(frame(spark, [])).count() == 0 and minhash.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_long_paths_and_hubs(spark):
    r = random.Random(5)
    path = list(range(100, 160))
    r.shuffle(path)
    edges = [tuple(sorted(e)) for e in zip(path, path[1:])] + [(1, k) for k in range(2, 40)] + [(39, 50), (200, 201), (200, 201)]
    got = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"))
    found = {x.node: x.component for x in got.collect()}
    assert {found[k] for k in path if k != 100} == {100} and {found[k] for k in [*range(2, 40), 50]} == {1} and found[201] == 200
    assert components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "test")).count() == 0
