"""Token counts by rank-synchronous merging over ragged numpy arrays.

The vocabulary is a public byte-pair encoding with word ends (normaliser NFC, white space to one space,
lower case; words, single digits, runs of other marks, and English contractions are pre-tokens). Pre-tokens
of a batch that are new become one flat array of symbol ids with sequence starts; each round finds every
sequence's lowest-rank pair and joins all of its places at once, until no pair is left; what remains is
counted. Counts of pre-tokens are remembered within a worker, up to ``CACHE`` of them.

A null text counts as empty (no bytes, no tokens). Special strings inside a text are one token each, as the
library has it by default. Texts of any length are counted whole. Repeated rows each give their row, an
empty table an empty result; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempolith.llm.common import table
from tempolith.llm.registry import query

#: Pre-tokens a worker remembers, about 150 bytes each; when full it starts anew.
CACHE = 400_000
NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next letter from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Merger:
    """The merges of a tokenizer file, applied to many pre-tokens at a time."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab["".join(p)] for p in pairs], np.int64)
        key = (left << 32) | right
        order = np.argsort(key, kind="stable")
        order = order[np.concatenate([[True], key[order][1:] != key[order][:-1]])]
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made
        # ranks whose product already takes part in an earlier merge: these go one place at a time
        first = np.full(max(vocab.values()) + 1, NONE, np.int64)
        np.minimum.at(first, np.concatenate([left, right]), np.concatenate([np.arange(len(pairs))] * 2))
        self.single = first[made] < np.arange(len(pairs))
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.library = Tokenizer.from_file(path)
        self.settled: dict[str, bool] = {}
        self.cache: dict[str, int] = {}

    def counts(self, words: list[str]) -> np.ndarray:
        """Symbols left of each word."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size)
        ids = self.inner[flat]
        ids[ends - 1] = self.last[flat[ends - 1]]
        seq = np.repeat(np.arange(len(words)), size)
        left = np.zeros(len(words), np.int64)
        while len(ids):
            key = (ids[:-1] << 32) | ids[1:]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            rank = np.where((self.key[at] == key) & (seq[1:] == seq[:-1]), self.rank[at], NONE)
            starts = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            rank = np.append(rank, np.int32(NONE))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NONE
            length = np.diff(np.append(starts, len(ids)))
            left[seq[starts[done]]] = length[done]
            each = np.repeat(lowest, length)
            hit = (rank == each) & (each != NONE)
            where = np.flatnonzero(hit)
            if len(where):
                # places that overlap: every other one of a run, from its left
                run = np.concatenate([[True], where[1:] != where[:-1] + 1])
                begin = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - begin) % 2 == 0]
                one = self.single[rank[where]]
                if one.any():
                    where = where[~one | np.concatenate([[True], seq[where][1:] != seq[where][:-1]])]
                ids[where] = self.made[rank[where]]
            stay = np.repeat(~done, length)
            stay[where + 1] = False
            ids, seq = ids[stay], seq[stay]
        return left

    def old(self, char: str) -> bool:
        """Known to Unicode 3.2, so that every library agrees about its kind and case."""
        known = self.settled.get(char)
        if known is None:
            known = self.settled[char] = unicodedata.ucd_3_2_0.category(char) != "Cn"
        return known

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special strings it holds.

        Characters newer than Unicode 3.2 may be classed differently by the libraries' Unicode tables;
        a text with such a character is normalised and cut by the tokenizer's own front end.
        """
        parts = self.special.split(text) if "<|" in text else [text]
        found: list[str] = []
        for part in parts:
            if not part.isascii():
                if not all(map(self.old, set(part))):
                    cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                    found += [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in cut]
                    continue
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            found += self.pattern.findall(part.lower())
        return found, len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces(t) for t in texts]
        known = self.cache
        new = list({w for words, _ in split for w in words if w not in known})
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list({w for words, _ in split for w in words})
        if new:
            known.update(zip(new, self.counts(new).tolist()))
        return [sum(map(known.__getitem__, words)) + special for words, special in split]


_loaded: dict[str, Merger] = {}


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens. ``vocabulary`` is the path of the tokenizer file on each executor."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merger = _loaded.get(vocabulary) or _loaded.setdefault(vocabulary, Merger(vocabulary))
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            counts: list[int] = []
            for i in range(0, len(texts), 256):
                counts += merger.count(texts[i:i + 256])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": frame["n_bytes"], "n_tokens": counts})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(work, f"doc_id {kind}, n_bytes long, n_tokens long")


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
