"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = {"n": 1, "key": "k", "shard": "s", "kept": "no", "keep_id": -1, "score": "x", "size": None, "component_id": 5, "md5": "m", "h": "h", "norm": "n",
         "host": "h", "path": "p", "copies": 9, "raw": "r", "features": 0, "toxic": 3, "bin": 2, "rank": 0}


def words(r: random.Random, n: int, pool: int = 4000) -> list[str]:
    return [f"w{r.randrange(pool)}" for _ in range(n)]


def awkward() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a long text, copies, near copies, repeated rows."""
    r = random.Random(11)
    base = words(r, 60)
    near = base[:30] + ["changed"] + base[31:]
    rows = [(1, " ".join(base), "en", "a"), (2, " ".join(base).upper(), "en", "b"), (3, " ".join(near), None, "b"), (4, None, "en", "a"), (5, "", "fr", None),
            (6, " \t\n ", "fr", "a"), (7, "one two", None, None), (8, "one  two", "en", "a"), (9, " ".join(words(r, 30000)), "en", "a"), (10, "Één Ünïcode ﬁ 🙂", "de", "c"),
            (11, "12 34 !!", "de", "c"), (None, "no id here", "en", "a"), (None, None, None, None), (12, "repeated row", "en", "a"), (12, "repeated row", "en", "a")]
    rows += [(100 + k, " ".join(words(r, 40)), "en", "abc"[k % 3]) for k in range(30)]
    return [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]


def clashing(df):
    return df.withColumns({c: F.lit(v) if v is not None else F.lit(None).cast("int") for c, v in CLASH.items()})


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    return clashing(df) if clash else df
