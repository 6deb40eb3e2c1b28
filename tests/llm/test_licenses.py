import re

import pytest

from tempolith.llm.license_rules import Rule, rules
from tempolith.llm.licenses import CORE, REACH, license_detections, license_labels
from tests.llm.helpers import awkward, frame

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _plain(text, signatures):
    """Detections by their definition: each rule at each word, then all pairs."""
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for p in range(len(words)):
        ahead = " ".join(words[p:p + REACH]) + " "
        for r in signatures:
            m = re.match(f"({r.pattern}) ", ahead)
            if m:
                found.append((p, p + len(m[1].split(" ")), r))

    def beats(o, d):
        long, short = o[1] - o[0], d[1] - d[0]
        return o[0] <= d[0] and o[1] >= d[1] and (o[2].priority < d[2].priority or (
            o[2].priority == d[2].priority and (long > short or o[2].order < d[2].order)))

    kept = [d for d in found if d[2].base or not any(beats(o, d) for o in found)]
    return len(words), found, kept


LINES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "under the mit license under the mit license",
         "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-2.0-or-later", "apache license, version 2 cc by nc",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "All rights reserved.",
         "under the MİT license", "underthe mit license", "Under\x00The_MIT-license", "CC-BY-NC-SA 4.0; see https://creativecommons.org/licenses/by-nc-sa/4.0/"]


def _texts():
    filler = "wort " * (CORE - 2)
    return LINES + [filler + "released under the MIT license " + filler + "cc by nc", "x " * 3 * CORE + LINES[6], "cc by nc " * 900, "", None,
                    " ".join(LINES * 40), "é under the mit license ü", "under the mit license" + "é", "gpl " * 700]


def test_labels_against_their_definition(spark):
    rows = [(k, t, "en", "a", None) for k, t in enumerate(_texts())] + [(None, LINES[0], None, None, None), (1, LINES[1], "en", "a", None), (1, LINES[0], "en", "a", None)]
    rows += awkward()
    got = license_labels(frame(spark, rows, clash=True).repartition(3)).collect()
    want = []
    for i, t, *_ in rows:
        n, found, kept = _plain(t, rules())
        base = sorted(d[0] for d in found if d[2].base)
        labels = lambda ds: ",".join(sorted({d[2].label for d in ds}))
        want.append((i, n, len(base), base[0] if base else None, base[-1] if base else None, labels([d for d in found if d[2].base]), labels(kept),
                     max([d[2].confidence for d in kept], default=0.0)))
    order = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)


def test_suppression_keeps_the_outer_and_the_first(spark):
    own = [Rule(0, "inner", "name", 5, 0.7, "beta", "beta", False), Rule(1, "outer", "name", 5, 0.7, "alpha", "alpha beta gamma", False),
           Rule(2, "low", "hint", 6, 0.3, "alpha", "alpha beta gamma delta", False), Rule(3, "high", "tag", 1, 1.0, "gamma", "gamma", False),
           Rule(4, "twin", "name", 5, 0.7, "alpha", "alpha beta gamma", False)]
    found = license_detections(frame(spark, [(1, "Alpha beta, gamma delta", None, None, None)]), signatures=own).first().detections
    assert {(d.label, d.start, d.end) for d in found} == {("inner", 1, 2), ("outer", 0, 3), ("low", 0, 4), ("high", 2, 3), ("twin", 0, 3)}
    assert {d.label for d in found if d.kept} == {"outer", "low", "high"}
    assert next(d.text for d in found if d.label == "low") == "alpha beta gamma delta"


def test_rules_are_sound():
    found = rules()
    assert len(found) > 200 and len({r.order for r in found}) == len(found)
    for r in found:
        pattern = re.compile(r.pattern)
        assert not pattern.groups and not pattern.match("")
        if "(" not in r.pattern and "[" not in r.pattern:  # a plain phrase holds its keyword, else it could never be found
            assert f" {r.keyword}" in f" {r.pattern}", r


def test_long_text_and_empty_table(spark):
    text = "lorem ipsum " * 300_000 + "Licensed under CC BY-NC 4.0. " + "dolor " * 1000
    (row,) = license_labels(frame(spark, [(1, text, None, None, None)])).collect()
    assert (row.n_words, row.n_base, row.first_word) == (600_000 + 7 + 1000, 1, 600_002)
    assert row.labels == "cc-by-nc,cc-by-nc-4.0" and row.base_labels == "cc-by-nc" and row.score == 0.9
    assert license_labels(frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["op11_licenses"])
def test_plan_is_native_and_shuffles_nothing(spark, name):
    plan = license_labels(frame(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
