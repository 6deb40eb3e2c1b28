import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tempolith.llm.mixing import mix, mixed, op3_mixing
from tempolith.llm.registry import ORACLE
from tempolith.llm.sharding import shard, sharded
from tests.llm.helpers import awkward, frame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_mix_against_its_law(spark):
    rows = awkward()
    got = mix(frame(spark, rows, clash=True)).collect()
    again = mix(frame(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.size, r.copies) for r in got if r.doc_id) == sorted((r.doc_id, r.size, r.copies) for r in again if r.doc_id)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want, open_ = {}, set(order)
    total = 1.5 * sum(sizes.values())
    while open_:  # reshare until no source is above its cap
        left = total - sum(want.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            want |= {s: level * weight[s] for s in open_}
            break
        want |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    by_size = {(r.source_size, round(r.target, 6)) for r in got}
    assert by_size == {(sizes[s], round(want[s], 6)) for s in order}
    taken, biggest = Counter(), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source_size] += r.taken
        biggest[r.source_size] = max(biggest[r.source_size], r.size)
    for s in order:
        assert abs(taken[sizes[s]] - want[s]) <= biggest[sizes[s]]


def test_mixed_rows_repeat_as_taken(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True)
    out = mixed(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in mix(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == +want
    assert mixed(frame(spark, [])).count() == 0 and mix(frame(spark, [])).count() == 0


def test_mix_query_equals_its_sql(spark, tmp_path):
    rows = awkward()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op3_mixing(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(ORACLE["op3_mixing"]).fetchall()
    assert sorted((r.doc_id or -1, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect()) == sorted((w[0] or -1, w[1], w[2], round(w[3], 6), w[4]) for w in want)


@pytest.mark.parametrize("n", [1, 3, 8])
def test_shards_are_even_gapless_and_keep_copies_together(spark, n):
    rows = [r for r in awkward() if r[0] != 9] + [(2000 + k, f"text {k} " * (1 + k % 17), "en", "a", 0) for k in range(400)]
    rows += [(5000 + k, "the same text many times over " * 3, "en", "a", 0) for k in range(300)]
    got = shard(frame(spark, rows, clash=True), n_shards=n).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    total, slots = Counter(), defaultdict(list)
    for r in got:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(total) == set(range(n))
    mean = sum(total.values()) / n
    assert max(abs(v - mean) for v in total.values()) <= 0.05 * mean + 300
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    heavy = zlib.crc32(b"the same text many times over " * 3)
    assert all(len(s) == 1 for c, s in where.items() if c != heavy)


def test_sharded_keeps_rows_and_columns(spark):
    rows = awkward()
    docs = frame(spark, rows, clash=True)
    out = sharded(docs, target_bytes=4000)
    assert set(out.columns) == set(docs.columns) | {"slot"} and out.count() == len(rows)
    assert sharded(frame(spark, []), target_bytes=100).count() == 0


def test_rows_without_an_id_or_a_chance_are_dealt_over_many_tasks(spark):
    from pyspark.sql import functions as F
    from tempolith.llm import mixing
    from tempolith.llm.common import numbered
    rows = [(None, f"text {k}", "en", "a", 0) for k in range(600)] + [(k, f"text {k}", "en", "b", 0) for k in range(10)] + [(1, "text 1", "en", "b", 0)]
    df = numbered(frame(spark, rows), "doc_id", F.col("text"))
    assert df.filter("doc_id IS NULL").select("__occ").distinct().count() == 600
    assert sorted(r[0] for r in df.filter("doc_id = 1").select("__occ").collect()) == [1, 2]
    # a source that stops at its cap has no chances: its rows fall into many bins, and all are taken whole
    hot = [(k, "w " * (1 + k % 5), "en", "hot", 0) for k in range(500)] + [(1000 + k, "w " * 40, "en", "cold", 0) for k in range(500)]
    got = mixing.mix(frame(spark, hot), weights=(1, 50)).collect()
    assert {r.copies for r in got if r.doc_id < 500} == {2}
    assert sum(r.taken for r in got if r.doc_id >= 1000) <= 1.5 * sum(r.size for r in got)
