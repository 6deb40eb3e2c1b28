import random
import zlib

import numpy as np
import pandas as pd

from tempolith.llm import language, toxicity
from tests.llm.helpers import awkward, frame

SF = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    got = language.op8_language(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/documents.parquet"), on="doc_id")
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95
    assert got["rejected"].mean() < 0.03 and got["score"].between(0, 1).all()
    assert set(got["lang_pred"]) <= {"en", "fr", "de", "es", "und"}


def test_language_of_awkward_rows(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True)
    books = language.learn(docs.select("doc_id", "text", "lang"))
    got = [tuple(r) for r in language.identify(docs, books).collect()]
    assert len(got) == len(rows)
    und = sorted(str(i) for i, p, s, x in got if p == "und")
    assert und == sorted(str(r[0]) for r in rows if not any(c.isalpha() for c in r[1] or ""))
    assert all(x and s == 0 for i, p, s, x in got if p == "und")
    none = language.identify(docs, language.learn(docs.filter("false").select("doc_id", "text", "lang"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language.identify(frame(spark, []), books).count() == 0


def test_mixed_and_unlearned_texts_are_rejected_at_every_length(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    learned = docs[[zlib.crc32(str(i).encode()) % 5 != 0 for i in docs["doc_id"]]]
    books = language.learn(spark.createDataFrame(learned[["doc_id", "text", "lang"]]))
    assert set(books.margins) == {"en", "fr", "de", "es"} and all(0.02 < m < 0.3 for m in books.margins.values())
    r = random.Random(3)
    # documents of one language that do not repeat themselves
    pools = {x: [t for t in docs.loc[docs["lang"] == x, "text"] if len(t) > 400 and len(zlib.compress(t.encode())) > 0.3 * len(t)] for x in ("en", "fr", "de", "es")}
    stems = "ja on että hän mutta kuin niin kun ovat tämä minä kaikki talo päivä vuosi ihminen kaupunki suomen kieli yksi kaksi hyvä suuri pieni".split()

    def of(lang, n):
        out = ""
        while len(out) < n:
            out += r.choice(pools[lang]) + " "
        return out[:n]

    def noise(n):
        return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 10))) for _ in range(n // 6))

    rows = []
    for n in (1000, 4000, 30000, 1000000):
        for a, b in (("de", "fr"), ("en", "es"), ("fr", "en")):
            rows.append(of(a, n // 2) + " " + of(b, n // 2))
        rows += [noise(n), " ".join(r.choice(stems) + r.choice(["", "ssa", "lla", "n", "ksi"]) for _ in range(n // 6)), "".join(chr(r.randrange(0x4E00, 0x5E00)) for _ in range(n // 3)),
                 of("es", n // 2) + " " + noise(n // 2)]
    bad = len(rows)
    rows += [of(x, n) for n in (4000, 30000, 1000000) for x in pools]
    texts = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {x.doc_id: x.rejected for x in language.identify(texts, books).collect()}
    assert [k for k in range(bad) if not got[k]] == [] and [k for k in range(bad, len(rows)) if got[k]] == []
    assert texts.filter(language.accepted(books, texts["text"])).count() == len(rows) - bad


def test_toxicity_on_held_out_rows(spark):
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    got = toxicity.op7_toxicity(spark, SF).toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    rank = held["score"].rank()
    ones, zeros = (held["toxic"] == 1).sum(), (held["toxic"] == 0).sum()
    area = (rank[held["toxic"] == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros)
    assert area > 0.85
    assert (held[held["toxic"] == 0]["predicted"] == 1).mean() < 0.03


def test_toxicity_with_odd_labels(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True).select("doc_id", "text")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.Scorer(docs, none).score(docs, "doc_id").collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (99999, 0), (None, 0), (2, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.Scorer(docs, one).score(docs, "doc_id").collect()} == {1.0}
    some = spark.createDataFrame([(i, i % 2) for i in [1, 2, 4, 5, *range(100, 130)]] + [(1, 0), (1, 1)], "doc_id long, toxic int")
    got = toxicity.Scorer(docs, some).score(docs, "doc_id").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)


def test_features_see_disguises_and_address():
    lexicon = frozenset({"idiot"})
    plain = dict(zip(toxicity.FEATURES, toxicity.features("you are an idiot", lexicon)))
    hidden = dict(zip(toxicity.FEATURES, toxicity.features("you are an 1d10t", lexicon)))
    clean = dict(zip(toxicity.FEATURES, toxicity.features("a calm sentence", lexicon)))
    assert plain["hits"] == 1 and plain["near_address"] == 1 and hidden["hidden_hits"] == 1 and hidden["mixed_words"] > 0
    assert clean["hits"] == clean["hidden_hits"] == 0 and np.isfinite(toxicity.features("\ud800 x", lexicon)).all()
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_shouted_words_count_in_texts_of_any_length():
    shout, calm = "YOU ARE AN IDIOT", "some calm words of a long text "
    at = toxicity.FEATURES.index("capital_words")
    for n in (0, 1, 20, 2000):
        text = calm * n + shout
        assert toxicity.features(text, frozenset())[at] == 4 / len(text.split())
    assert toxicity.features(calm, frozenset())[at] == 0


def test_toxicity_of_nothing_and_with_clashing_columns(spark):
    rows = awkward()
    some = spark.createDataFrame([(i, i % 2) for i in range(100, 130)], "doc_id long, toxic int")
    plain, clash = frame(spark, rows), frame(spark, rows, clash=True)
    key = lambda r: str((r.doc_id, r.score))
    got = [sorted(map(key, toxicity.Scorer(d, some).score(d, "doc_id").collect())) for d in (plain, clash)]
    assert got[0] == got[1] and len(got[0]) == len(rows)
    none = frame(spark, [])
    assert toxicity.Scorer(none, some).score(none, "doc_id").count() == 0
    assert len(toxicity.Scorer(none, some).score(plain, "doc_id").collect()) == len(rows)


def test_languages_that_tie_are_rejected_and_named_by_the_first():
    """Two dictionaries of the same bytes: every text ties, the first name wins, and the row is rejected."""
    books = language.Books({"xx": b"one two three four five six " * 40, "aa": b"one two three four five six " * 40})
    judge = language.Judge(books)
    for text in ("one two three", "one two three four five six " * 300, "nothing of it 123"):
        name, score, rejected = judge.of(text)
        assert name == "aa" and rejected and abs(score - 0.5) < 1e-9
    assert judge.of("12 34") == ("und", 0.0, True) and judge.of(None) == ("und", 0.0, True)
