import random

from collections import defaultdict

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from talespan.functions.uris import uri_key
from talespan.operators import hierarchy as tree, intervals
from talespan.operators.intervals import IntervalMap, merge_intervals, segment_periods
from talespan.streaming.intervals import stream_periods


def brute(nodes, edges):
    """(root, depth, descendants, in cycle) by plain searches."""
    below, above = defaultdict(set), defaultdict(set)
    for a, b in edges:
        below[a].add(b)
        above[b].add(a)
    best = {}
    for r in sorted(n for n in nodes if not above[n]):
        level, front = {r: 0}, [r]
        while front:
            nxt = []
            for v in front:
                for c in below[v]:
                    if c not in level:
                        level[c] = level[v] + 1
                        nxt.append(c)
            front = nxt
        for v, d in level.items():
            best[v] = min(best.get(v, (d, r)), (d, r))
    out = {}
    for n in nodes:
        seen, stack = set(), [n]
        while stack:
            for c in below[stack.pop()]:
                if c not in seen:
                    seen.add(c)
                    stack.append(c)
        d, r = best.get(n, (-1, -1))
        out[n] = (r, d, len(seen - {n}), int(n in seen))
    return out


@settings(max_examples=300, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=16))
def test_local_contraction_equals_search(edges):
    want = brute(range(10), edges)
    for v, root, depth, path, total, cycle, _ in tree.solve_local([(a, b, 1, 0, []) for a, b in sorted(edges)], {}):
        assert (root, depth, total - cycle, cycle) == want[v]
        assert len(path) == depth + 1 and all(e in edges for e in zip(path, path[1:]))


@pytest.fixture(scope="module")
def graph():
    rng = random.Random(5)
    edges = {(rng.randrange(max(0, v - 3), v), v) for v in range(1, 30)} | {(v - 1, v) for v in range(31, 50)} | {(0, 30), (50, 51), (51, 52), (52, 50), (53, 53), (3, 20), (5, 25), (51, 54)}
    return list(range(60)), sorted(edges)


def graph_frames(spark, nodes, edges):
    return spark.createDataFrame([(n,) for n in nodes], "id int"), spark.createDataFrame(edges, "p int, c int")


def random_graph(seed):
    """Trees, chains into and out of cycles, shared nodes, self-links, two-cycles, lone nodes."""
    rng = random.Random(seed)
    n = 70
    edges = {(rng.randrange(max(0, v - 4), v), v) for v in range(1, 25)} | {(v - 1, v) for v in range(26, 38)} | {(60, 61), (61, 60), (62, 62), (62, 63)}
    edges |= {(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([0, 2, 8, 30]))}
    if rng.random() < 0.5:
        edges.add((37, rng.randrange(26, 37)))
    return list(range(n)), sorted(edges)


@pytest.mark.parametrize("seed, limit", [(0, -1), (3, 8)])
def test_contraction_equals_search(spark, seed, limit):
    nodes, edges = random_graph(seed)
    want = brute(nodes, edges)
    rows = tree.hierarchy(*graph_frames(spark, nodes, edges), local_edges=limit, paths=False).collect()
    assert {r.id: (r.root, r.depth, r.n_descendants, r.in_cycle) for r in rows} == want and len(rows) == len(nodes)
    below = defaultdict(set)
    for a, b in edges:
        below[a].add(b)
    reach = set()
    for a in nodes:
        seen, stack = set(), [a]
        while stack:
            for c in below[stack.pop()] - seen:
                seen.add(c)
                stack.append(c)
        reach |= {(a, d) for d in seen if d != a}
    got = tree.descendants(*graph_frames(spark, nodes, edges), local_edges=limit).collect()
    assert {tuple(r) for r in got} == reach and len(got) == len(reach)


def test_a_deep_chain_needs_few_rounds_and_no_paths(spark, monkeypatch):
    rounds = []
    real = tree._round
    monkeypatch.setattr(tree, "_round", lambda *a: rounds.append(a[-1]) or real(*a))
    n = 3000
    rows = tree.hierarchy(spark.range(n).selectExpr("int(id) AS id"), spark.range(1, n).selectExpr("int(id - 1) AS p", "int(id) AS c"), local_edges=500, paths=False).collect()
    assert {r.id: (r.root, r.depth, r.n_descendants) for r in rows} == {i: (0, i, n - 1 - i) for i in range(n)} and len(rounds) < 12 and "path" not in rows[0]


@pytest.mark.parametrize("limit", [1000, 12, -1])
def test_hierarchy_distributed(spark, graph, limit):
    nodes, edges = graph
    rows = tree.hierarchy(spark.createDataFrame([(n,) for n in nodes], "id int"), spark.createDataFrame(edges, "p int, c int"), local_edges=limit).collect()
    assert {r.id: (r.root, r.depth, r.n_descendants, r.in_cycle) for r in rows} == brute(nodes, edges) and len(rows) == len(nodes)
    assert all(len(r.path) == r.depth + 1 and all(e in edges for e in zip(r.path, r.path[1:])) for r in rows)


def test_concept_edges_dirt(spark):
    rows = [(1, "http://v/x/1", ["https://v/x/2/", " http://v/x/2", None, "", "http://v/none", "http://v/x/1"]), (1, "http://v/x/1", ["http://v/X/3#a"]), (2, "http://v/x/2", None),
            (3, "http://v/x/3", []), (3, "http://v/x/3", []), (None, "http://v/x/9", ["http://v/x/1"])]
    c = spark.createDataFrame(rows, "concept_idx int, uri string, narrower array<string>").withColumn("key", F.lit("clash")).withColumn("id", F.lit(0))
    nodes, edges = tree.concept_edges(c)
    assert sorted(r.id for r in nodes.collect()) == [1, 2, 3] and sorted((r.p, r.c) for r in edges.collect()) == [(1, 1), (1, 2), (1, 3)]
    got = {r.id: (r.root, r.depth, r.n_descendants, r.in_cycle) for r in tree.hierarchy(nodes, edges).collect()}
    assert got == {1: (-1, -1, 2, 1), 2: (-1, -1, 0, 0), 3: (-1, -1, 0, 0)}


def test_hierarchy_empty(spark):
    nodes, edges = tree.concept_edges(spark.createDataFrame([], "concept_idx int, uri string, narrower array<string>"))
    assert tree.hierarchy(nodes, edges).count() == 0


def test_uri_key(spark):
    same = ["https://t.example/th/k/1", "HTTP://www.T.example/th//k/1/", " <https://t.example/t%68/k/1?x=1#y> ", "t.example:443/th/k/1\n"]
    keys = {r[0] for r in spark.createDataFrame([(s,) for s in same], "u string").select(uri_key(F.col("u"))).collect()}
    assert keys == {"t.example/th/k/1"}
    # The short way gives what the long way gives for the same uri in another spelling.
    plain = ["https://t.example/a-b/c_d/1.2~x", "http://t.example", "https://t.example/a//b", "https://www.t.example/a", "https://t.example/a/", "https://t.example/a:80", "https://t.example/a b", "https://t.example/a/é", "https://t.example/a/1\n", "https://t.example/a/1\r\n"]
    for p in plain:
        one, two = (r[0] for r in spark.createDataFrame([(p,), (f" <{p}> ",)], "u string").select(uri_key(F.col("u"))).collect())
        assert one == two
    odd = spark.createDataFrame([("",), (" ",), (None,), ("%zz",)], "u string").select(uri_key(F.col("u")).alias("k"))
    assert sorted(str(r.k) for r in odd.collect()) == ["%zz", "None", "None", "None"]


def merged(rows):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 15)), max_size=25))
def test_interval_map(rows):
    held = IntervalMap()
    for s, n in rows:
        held.insert(s, s + n)
    want = merged([(s, s + n) for s, n in rows])
    assert [list(x) for x in zip(held.starts, held.ends)] == want
    assert held.gaps() == [(a[1], b[0]) for a, b in zip(want, want[1:])]


def test_equal_starts_are_reduced_before_the_shuffle(spark, monkeypatch):
    plans = []
    real = intervals.materialize
    monkeypatch.setattr(intervals, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or real(df, name))
    df = spark.range(20_000).selectExpr("1 AS k", "id % 3 * 100 AS start_ms", "id % 3 * 100 + id % 50 + 1 AS end_ms")
    got = sorted(tuple(r) for r in merge_intervals(df, ["k"]).collect())
    assert got == [(1, "gap", 50, 100), (1, "gap", 150, 200), (1, "period", 0, 50), (1, "period", 100, 150), (1, "period", 200, 250)]
    below = plans[0].partition("Exchange")[2]
    assert "HashAggregate" in below and "partial_max" in below


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_merge_intervals_over_blocks(spark, block):
    rng = random.Random(block)
    rows = [(k, s, s + rng.choice([1, 3, 8, 60])) for k in ("a", "b", None) for s in (rng.randrange(400) for _ in range(60))]
    got = defaultdict(list)
    df = spark.createDataFrame(rows, "k string, start_ms long, end_ms long").withColumn("kind", F.lit("clash")).withColumn("s", F.lit(1))
    for r in merge_intervals(df, ["k"], block_ms=block).collect():
        got[(r.k, r.kind)].append([r.start_ms, r.end_ms])
    for k in ("a", "b", None):
        want = merged([(s, e) for x, s, e in rows if x == k])
        assert sorted(got[(k, "period")]) == want
        assert sorted(got[(k, "gap")]) == [[a[1], b[0]] for a, b in zip(want, want[1:])]


def test_segment_periods_dirt(spark):
    rows = [(1, 1, 0.0, 1.0), (1, 1, 1.0, 2.0), (1, 1, 1.0, 2.0), (1, 1, 5.0, 4.0), (1, 1, 6.0, 6.0), (1, 1, None, 9.0), (1, 1, float("nan"), 9.0), (1, 1, 3.0005, 4.0), (1, 2, -1.0, 1.0), (1, 2, 2.0, float("inf")), (1, 2, -1e300, 5.0), (1, 3, 1e300, 2e300)]
    df = spark.createDataFrame(rows, "transcript_id long, tape_no int, start_s double, end_s double")
    got = sorted((r.tape_no, r.kind, r.start_ms, r.end_ms) for r in segment_periods(df).collect())
    assert got == [(1, "gap", 2000, 3001), (1, "period", 0, 2000), (1, "period", 3001, 4000), (2, "period", -1000, 1000)]
    assert segment_periods(df.limit(0)).count() == 0


def test_stream_keeps_state(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    stream = spark.readStream.schema("k string, start_ms long, end_ms long").parquet(str(src))
    q = (stream_periods(stream, ["k"]).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
         .foreachBatch(lambda df, n: seen.extend(tuple(r) for r in df.collect())).start())
    try:
        for i, rows in enumerate(([("a", 0, 5), ("a", 10, 12)], [("a", 4, 10), ("b", 1, 2)])):
            pd.DataFrame(rows, columns=["k", "start_ms", "end_ms"]).to_parquet(src / f"{i}.parquet")
            q.processAllAvailable()
    finally:
        q.stop()
    last = {k: max(r[4] for r in seen if r[0] == k) for k in ("a", "b")}
    assert sorted(r[:4] for r in seen if r[4] == last[r[0]]) == [("a", "period", 0, 12), ("b", "period", 1, 2)]
    assert ("a", "gap", 5, 10, 1) in seen


def test_vtt_stream(spark, tmp_path):
    from talespan.streaming.captions import stream_captions

    src = tmp_path / "v"
    src.mkdir()
    (src / "a.vtt").write_text("WEBVTT\n\n00:01.000 --> 00:02.000\nX\n")
    q = stream_captions(spark, str(src)).writeStream.format("memory").queryName("vtt_rows").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
        (src / "b.vtt").write_text("WEBVTT\n\n00:03.000 --> 00:04.000\nY\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r.file_name, r.text) for r in spark.sql("SELECT * FROM vtt_rows").collect()) == [("a.vtt", "X"), ("b.vtt", "Y")]
