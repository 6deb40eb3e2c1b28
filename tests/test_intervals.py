"""Active-set reconstruction, interval assignment and on/off splits."""

from pyspark.sql import functions as F

from tempolith.operators import intervals as IV


def _parts(spark):
    # one group; starters 1..3; at t=10: 1 out, 4 in; at t=20: 4 out AND in (in wins), 2 out, 5 in
    changes = spark.createDataFrame([(1, 1, 10, False), (1, 4, 10, True), (1, 4, 20, False), (1, 4, 20, True),
                                     (1, 2, 20, False), (1, 5, 20, True)], "g int, m int, clk int, is_in boolean")
    starters = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "g int, m int")
    spans = spark.createDataFrame([(1, 0, 30)], "g int, start int, end int")
    return changes, starters, spans


def test_active_sets_last_change_wins_in_beats_out(spark):
    ch, st, sp = _parts(spark)
    iv = IV.active_intervals(ch, st, sp, "g", "m", "clk", "is_in", size=None)
    got = [(r.start, r.end, r.lineup) for r in iv.orderBy("k").collect()]
    assert got == [(0, 10, "1-2-3"), (10, 20, "2-3-4"), (20, 30, "3-4-5")]


def test_active_sets_credit_after(spark):
    ch, st, sp = _parts(spark)
    iv = IV.active_intervals(ch, st, sp, "g", "m", "clk", "is_in", size=None, credit="after")
    got = [(r.start, r.lineup) for r in iv.orderBy("k").collect()]
    assert got == [(0, "2-3-4"), (10, "3-4-5"), (20, "3-4-5")]


def test_size_filter(spark):
    ch, st, sp = _parts(spark)
    assert IV.active_intervals(ch, st, sp, "g", "m", "clk", "is_in", size=4).count() == 0


def test_assign_intervals_right_closed_across_buckets(spark):
    ch, st, sp = _parts(spark)
    bnd = IV.boundaries(ch, sp, "g", "clk")
    ev = spark.createDataFrame([(1, 0), (1, 5), (1, 10), (1, 11), (1, 20), (1, 29), (1, 30)], "g int, t int")
    out = IV.assign_intervals(ev, bnd, "g", "t", bucket_width=7.0, closed="right").orderBy("t").collect()
    assert [r.k for r in out] == [None, 1, 1, 2, 2, 3, 3]
    out = IV.assign_intervals(ev, bnd, "g", "t", bucket_width=7.0, closed="left").orderBy("t").collect()
    assert [r.k for r in out] == [1, 1, 2, 2, 3, 3, 4]


def test_on_plus_off_equals_group_total(spark):
    iv = spark.createDataFrame([(1, [1, 2], 5.0), (1, [2, 3], 7.0), (1, [1, 3], 11.0)],
                               "g int, members array<int>, pts double")
    oo = IV.on_off(iv, "g", ["pts"]).orderBy("member").collect()
    assert [(r.member, r.on_pts, r.off_pts) for r in oo] == [(1, 16.0, 7.0), (2, 12.0, 11.0), (3, 18.0, 5.0)]


def test_first_members(spark):
    ev = spark.createDataFrame([(1, 9, 1, "x"), (1, 7, 2, "sub"), (1, 8, 3, "x"), (1, 9, 4, "x"), (1, 6, 5, "x")],
                               "g int, m int, seq int, kind string")
    fm = IV.first_members(ev, "g", "m", "seq", n=2, exclude=F.col("kind") == "sub").orderBy("slot").collect()
    assert [r.m for r in fm] == [9, 8]


def test_skew_safe_boundaries_equal_window_boundaries(spark):
    import random
    rnd = random.Random(3)
    changes = spark.createDataFrame([(g, rnd.randint(1, 9), rnd.randint(0, 5000 if g == 1 else 50), True)
                                     for g in range(4) for _ in range(3000 if g == 1 else 20)],
                                    "g int, m int, clk int, is_in boolean")
    spans = spark.createDataFrame([(g, -1, 6000) for g in range(4)], "g int, start int, end int")
    a = IV.boundaries(changes, spans, "g", "clk").select("g", "b", "k", "b_next", "n_b")
    b = IV.boundaries(changes, spans, "g", "clk", skew_safe=True, partitions=8).select("g", "b", "k", "b_next", "n_b")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def _fold(changes, starters, start, end, credit):
    """Sequential reference: walk the boundaries in time order; at each one
    remove the members going out, then add the members coming in."""
    bounds = sorted({c for _, c, _ in changes} | {start, end})
    state = set(starters)
    lineups = []
    if credit == "before":
        for i, b in enumerate(bounds[:-1]):
            for phase in (False, True):
                for m, c, is_in in changes:
                    if c == b and is_in == phase:
                        (state.add if is_in else state.discard)(m)
            lineups.append((b, bounds[i + 1], "-".join(map(str, sorted(state)))))
    else:   # state after the changes at the interval's end; changes at the first boundary ignored
        for i, b in enumerate(bounds[:-1]):
            nxt = bounds[i + 1]
            for phase in (False, True):
                for m, c, is_in in changes:
                    if c == nxt and is_in == phase:
                        (state.add if is_in else state.discard)(m)
            lineups.append((b, nxt, "-".join(map(str, sorted(state)))))
    return lineups


def test_active_sets_equal_sequential_fold_on_random_logs(spark):
    import random
    rnd = random.Random(7)
    ch_rows, st_rows, sp_rows, expect = [], [], [], {"before": [], "after": []}
    for g in range(25):
        start, end = 0, 100
        starters = rnd.sample(range(1, 9), rnd.randint(0, 5))
        changes = [(rnd.randint(1, 8), rnd.choice([0, 0, 10, 20, 35, 50, 70, 100]), rnd.random() < 0.5)
                   for _ in range(rnd.randint(0, 12))]
        ch_rows += [(g, m, c, i) for m, c, i in changes]
        st_rows += [(g, m) for m in starters]
        sp_rows.append((g, start, end))
        for credit in ("before", "after"):
            expect[credit] += [(g, s, e, lu) for s, e, lu in _fold(changes, starters, start, end, credit)]
    ch = spark.createDataFrame(ch_rows, "g int, m int, clk int, is_in boolean")
    st = spark.createDataFrame(st_rows, "g int, m int")
    sp = spark.createDataFrame(sp_rows, "g int, start int, end int")
    for credit in ("before", "after"):
        iv = IV.active_intervals(ch, st, sp, "g", "m", "clk", "is_in", size=None, credit=credit)
        got = sorted((r.g, r.start, r.end, r.lineup) for r in iv.collect())
        assert got == sorted(expect[credit]), credit


def test_min_duration_and_excluded_groups(spark):
    ch, st, sp = _parts(spark)
    two = st.union(spark.createDataFrame([(2, 1)], "g int, m int"))
    sp2 = sp.union(spark.createDataFrame([(2, 0, 30)], "g int, start int, end int"))
    iv = IV.active_intervals(ch, two, sp2, "g", "m", "clk", "is_in", size=None, min_duration=10, exclude={"g": [2]})
    assert sorted({r.g for r in iv.collect()}) == [1]
    assert IV.active_intervals(ch, st, sp, "g", "m", "clk", "is_in", size=None, min_duration=11).count() == 0


def test_boundaries_shared_by_the_teams_of_an_event(spark):
    from tempolith.operators import intervals as IV
    changes = spark.createDataFrame([(1, "a", 10, 5, True), (1, "b", 20, 7, True), (2, "a", 10, 3, True)], "event int, team string, member long, clk int, is_in boolean")
    spans = spark.createDataFrame([(1, "a", 0, 9), (1, "b", 0, 9), (2, "a", 0, 9)], "event int, team string, start int, end int")
    own = IV.boundaries(changes, spans, ["event", "team"], "clk")
    shared = IV.boundaries(changes, spans, ["event", "team"], "clk", event="event")
    got = lambda df: sorted((r.event, r.team, r.b) for r in df.collect())      # noqa: E731
    assert got(own) == [(1, "a", 0), (1, "a", 5), (1, "a", 9), (1, "b", 0), (1, "b", 7), (1, "b", 9), (2, "a", 0), (2, "a", 3), (2, "a", 9)]
    assert got(shared) == [(1, t, b) for t in "ab" for b in (0, 5, 7, 9)] + [(2, "a", 0), (2, "a", 3), (2, "a", 9)]
    starters = spark.createDataFrame([], "event int, team string, member long")
    iv = IV.active_intervals(changes, starters, spans, ["event", "team"], "member", "clk", "is_in", size=1, bnd=shared)
    assert sorted((r.event, r.team, r.start, r.end, r.lineup) for r in iv.collect()) == [(1, "a", 5, 7, "10"), (1, "a", 7, 9, "10"), (1, "b", 7, 9, "20"), (2, "a", 3, 9, "10")]


def test_corrected_groups_are_rebuilt_and_others_kept(spark):
    from tempolith.operators import intervals as IV
    from tempolith.plans import jobs as J
    schema = "grp int, member long, clk int, is_in boolean"
    old = spark.createDataFrame([(1, 10, 2, True), (2, 20, 3, True)], schema)
    new = spark.createDataFrame([(1, 10, 2, True), (2, 20, 4, True), (3, 30, 1, True)], schema)
    spans = spark.createDataFrame([(1, 0, 9), (2, 0, 9), (3, 0, 9)], "grp int, start int, end int")
    none = spark.createDataFrame([], "grp int, member long")
    existing = IV.active_intervals(old, none, spans.filter("grp < 3"), "grp", "member", "clk", "is_in", size=1)
    out = J.intervals_incremental(existing, J.change_summary(old, "grp"), new, none, spans, "grp", "member", "clk", "is_in", 1)
    assert sorted((r.grp, r.start, r.lineup) for r in out.collect()) == [(1, 2, "10"), (2, 4, "20"), (3, 1, "30")]
