import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempolith.llm.common import LOWER, UPPER
from tempolith.llm.exact_dedup import exact_duplicates
from tempolith.llm.token_counts import Merger, count_tokens
from tests.llm.helpers import awkward, frame

FOLD = str.maketrans(UPPER, LOWER)
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def brute(rows, best):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    out = []
    for norm, ids in groups.items():
        keep = best([i for i in ids if i is not None], default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_exact_dedup_against_brute_force(spark):
    rows = awkward()
    for keep, best in (("max", max), ("min", min)):
        got = exact_duplicates(frame(spark, rows, clash=True), keep=keep).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, best)


def test_exact_dedup_tells_texts_with_one_hash_apart(spark):
    rows = awkward()
    got = exact_duplicates(frame(spark, rows), keep="max", hash_of=lambda c: F.encode((F.length(c) % 7).cast("string"), "UTF-8")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, max)


def test_exact_dedup_of_nothing(spark):
    assert exact_duplicates(frame(spark, [])).count() == 0


def test_token_counts_equal_the_library(spark):
    rows = awkward()
    extra = ["<|startoftext|>hi<|endoftext|>", "can't I'LL 's ''s !'s", "a" * 3000, "ΑΣ ΟΔΥΣΣΕΥΣ İ ß ǅ", "漢字 한글 \x1c\x85 x", "１２ Ⅲ ½", "é ᾼ ᲀ 🫠"]
    rows += [(1000 + k, t, None, None, None) for k, t in enumerate(extra)]
    library = Tokenizer.from_file(VOCABULARY)
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows), key=str)
    got = count_tokens(frame(spark, rows, clash=True), VOCABULARY).collect()
    assert sorted(map(tuple, got), key=str) == want
    assert count_tokens(frame(spark, []), VOCABULARY).count() == 0


def test_merger_forgets_when_full(monkeypatch):
    monkeypatch.setattr("tempolith.llm.token_counts.CACHE", 3)
    merger = Merger(VOCABULARY)
    texts = ["alpha beta gamma delta", "epsilon zeta alpha", "hello world"]
    library = Tokenizer.from_file(VOCABULARY)
    assert [n for t in texts for n in merger.count([t])] == [len(library.encode(t).ids) for t in texts]
