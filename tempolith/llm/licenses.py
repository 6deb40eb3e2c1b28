"""License scans: ordered signature rules behind a keyword prefilter, with suppression of contained detections.

Texts are lower-cased (A-Z only) and cut into words, runs of letters, digits and anything beyond ASCII. A detection of
a rule is a word at which its pattern starts to match, with the words up to the match's end; so what is found at a
word depends on the ``REACH`` words from it and on nothing before. A detection is suppressed when its interval lies
within that of another one of higher priority, of one of the same priority that is longer, or of an earlier rule with
the same interval and priority. Base phrases keep all their places.

Everything is one narrow pass of built-in functions over each row: a row whose text holds no keyword is only counted;
others are cut into passages of ``CORE`` words with ``REACH`` more on both sides, which hold whatever can match at or
contain a detection in their core, and a passage is only searched by the rules whose keyword it holds. So a text of
any length is read whole, in memory of its own size, and the pairs that suppression compares stay inside a passage.
Nothing is shuffled, so no key can be hot and a lost executor's rows are simply read again.

A null text counts as empty: no words, no detections. Every input row gives one output row, in whatever order;
repeated rows and null ids are rows like others. Ties are settled by the order of the rules. An empty table gives an
empty result; columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import LOWER, UPPER, table
from tempolith.llm.license_rules import Rule, rules
from tempolith.llm.registry import query

#: What parts words; the rest is ASCII letters and digits and everything beyond ASCII.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words in the middle of a passage, and words that a pattern covers at most.
CORE, REACH = 512, 64

_RULE = "struct<order:int,label:string,kind:string,priority:int,confidence:double,keyword:string,pattern:string,base:boolean>"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _keyword_pattern(found: list[Rule]) -> str:
    """Any keyword at the start of a word, in either case; a keyword that starts with another one adds nothing."""
    heads: list[str] = []
    for word in sorted({r.keyword for r in found}):
        if not heads or not word.startswith(heads[-1]):
            heads.append(word)
    return "(?i) (?:" + "|".join(heads) + ")"


def _groups(found: list[Rule]) -> Column:
    """The rules as one constant, by keyword, so that a passage is searched for each keyword once."""
    by: dict[str, list[dict]] = {}
    for r in found:
        by.setdefault(r.keyword, []).append(r._asdict())
    value = [{"keyword": f" {k}", "rules": v} for k, v in by.items()]
    return F.from_json(F.lit(json.dumps(value)), f"array<struct<keyword:string,rules:array<{_RULE}>>>")


def _places(view: Column, rule: Column, at: Column) -> Column:
    """Where a rule matches in a passage: at every word by itself, so matches may overlap."""
    look = F.concat(F.lit("(?<= )(?=("), rule["pattern"], F.lit(") )"))
    cut = F.concat(F.lit("(?<= )(?=(?:"), rule["pattern"], F.lit(") )"))
    matched = F.regexp_extract_all(view, look, F.lit(1))
    pieces = F.split(view, cut, -1)  # one more than there are matches

    def place(text: Column, k: Column) -> Column:
        before = F.aggregate(F.slice(pieces, F.lit(1), k + 1), at - 1, lambda n, piece: n + _spaces(piece))
        return F.struct(before.alias("start"), (before + _spaces(text) + 1).alias("end"), rule["label"].alias("label"),
                        rule["order"].alias("rule"), rule["kind"].alias("kind"), rule["priority"].alias("priority"),
                        rule["confidence"].alias("confidence"), rule["base"].alias("base"), text.alias("text"))

    return F.transform(matched, place)


def _contains(outer: Column, inner: Column) -> Column:
    """Whether ``outer`` suppresses ``inner``."""
    long, short = outer["end"] - outer["start"], inner["end"] - inner["start"]
    first = (outer["priority"] < inner["priority"]) | (
        (outer["priority"] == inner["priority"]) & ((long > short) | (outer["rule"] < inner["rule"])))
    return (outer["start"] <= inner["start"]) & (outer["end"] >= inner["end"]) & first


def license_detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       signatures: list[Rule] | None = None) -> DataFrame:
    """Per row: id, n_words and ``detections``, an array in the order of the text.

    A detection has start and end (words from 0, end exclusive), label, rule (its number), kind, priority,
    confidence, base, the matched words, and kept: whether it is left after suppression.
    """
    found = rules() if signatures is None else signatures
    keywords, groups = _keyword_pattern(found), _groups(found)
    plain = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), GAP, " "))
    rows = docs.select(F.col(id_col), plain.alias("__plain"))
    n_words = F.when(F.col("__plain") == "", 0).otherwise(_spaces(F.col("__plain")) + 1).cast("long")
    words = F.split(F.translate(F.col("__plain"), UPPER, LOWER), " ", -1)

    def view(k: Column) -> Column:
        first = F.greatest(k * CORE - REACH, F.lit(0))
        text = F.array_join(F.slice(F.col("__words"), first + 1, (k + 1) * CORE + REACH - first), " ")
        return F.struct((k * CORE).alias("core"), first.alias("first"), F.concat(F.lit(" "), text, F.lit(" ")).alias("text"))

    def search(p: Column) -> Column:
        tried = F.filter(groups, lambda g: F.contains(p["text"], g["keyword"]))
        return F.flatten(F.transform(F.flatten(F.transform(tried, lambda g: g["rules"])), lambda r: _places(p["text"], r, p["first"])))

    def settle(p: Column) -> Column:
        core = F.filter(p["all"], lambda d: (d["start"] >= p["core"]) & (d["start"] < p["core"] + CORE))
        return F.transform(core, lambda d: d.withField("kept", d["base"] | ~F.exists(p["all"], lambda o: _contains(o, d))))

    # Steps are columns of their own, so each is computed once; a text without a keyword has none of them.
    held = rows.select(id_col, n_words.alias("n_words"),
                       F.when(F.concat(F.lit(" "), F.col("__plain")).rlike(keywords), words).alias("__words"))
    views = F.filter(F.transform(F.sequence(F.lit(0), F.floor((F.size("__words") - 1) / CORE).cast("int")), view),
                     lambda p: p["text"].rlike(keywords))
    held = held.withColumn("__views", F.when(F.col("__words").isNotNull(), views)).drop("__words")
    held = held.withColumn("__found", F.transform("__views", lambda p: F.struct(p["core"].alias("core"), search(p).alias("all"))))
    detections = F.array_sort(F.flatten(F.transform("__found", settle)))
    return held.select(id_col, "n_words", F.coalesce(detections, F.array().cast(_DETECTIONS)).alias("detections"))


_DETECTIONS = ("array<struct<start:int,end:int,label:string,rule:int,kind:string,priority:int,confidence:double,base:boolean,"
               "text:string,kept:boolean>>")


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best kept confidence, 0 if none)."""
    found = license_detections(docs, id_col, text_col, signatures)
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: d["kept"])

    def joined(part: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(part, lambda d: d["label"]))), ",")

    starts = F.transform(base, lambda d: d["start"].cast("long"))
    return found.select(id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(kept).alias("labels"),
                        F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0)).alias("score"))


def _sql() -> str:
    """The same by its definition: every word of a text against every rule whose keyword the text holds."""
    def quoted(x) -> str:
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)

    values = ",\n".join("(" + ", ".join(quoted(x) for x in (r.order, r.label, r.priority, r.confidence, r.keyword, r.pattern, r.base)) + ")" for r in rules())
    return rf"""
    WITH rules(rule, label, priority, confidence, keyword, pattern, base) AS (VALUES {values}),
    texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
    tried AS (SELECT r, words, rules.* FROM texts JOIN rules ON contains(' ' || array_to_string(words, ' '), ' ' || keyword)),
    heads AS (SELECT *, unnest(generate_series(1, len(words))) AS p FROM tried),
    near AS (SELECT * EXCLUDE (words), array_to_string(words[p : p + {REACH - 1}], ' ') || ' ' AS ahead FROM heads),
    hits AS (SELECT * EXCLUDE (ahead), rtrim(regexp_extract(ahead, '^(?:' || pattern || ') ', 0)) AS said FROM near
             WHERE starts_with(ahead, substr(pattern, 1, 1)) OR substr(pattern, 1, 1) IN ('(', '[')),
    found AS (SELECT r, p - 1 AS s, p - 1 + len(string_split(said, ' ')) AS e, rule, label, priority, confidence, base FROM hits WHERE said <> ''),
    kept AS (SELECT * FROM found d WHERE base OR NOT EXISTS (
        SELECT 1 FROM found o WHERE o.r = d.r AND o.s <= d.s AND o.e >= d.e AND (o.priority < d.priority
            OR (o.priority = d.priority AND (o.e - o.s > d.e - d.s OR o.rule < d.rule))))),
    per AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score FROM kept GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
           coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
    FROM texts LEFT JOIN per USING (r)"""


@query("op11_licenses", _sql())
def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))
