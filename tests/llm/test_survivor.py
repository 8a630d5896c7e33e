import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from talespan.llm import survivor as s

TRUST = [("Manual review", 1), ("Exact occurrence", 2)]
SCHEMA = "match_id long, transcript_id long, segment_idx int, match_idx int, uri string, source string, score double, evidence string, scored_at timestamp_ntz"


def brute(rows):
    """Survivors straight from the definition."""
    groups = {}
    for r in dict((r[0], r) for r in rows).values():
        if r[4]:
            groups.setdefault((r[1], r[2], r[4]), []).append(r)
    rank = {"manualreview": 1, "exactoccurrence": 2}
    key = lambda x: "".join(c for c in (x or "").lower() if c.isalnum())
    out = set()
    for (t, i, _), g in groups.items():
        if len(g) < 2:
            continue
        good = {r[0]: (r[6] is not None and r[6] == r[6] and 0 <= r[6] <= 1, (r[7] or "").strip() not in ("", "-", "None", "geen"), key(r[5]) in rank) for r in g}
        pref = lambda r: (rank.get(key(r[5]), 9), -(r[8].timestamp() if r[8] else -1e12), r[0])
        first = lambda x: min(x, key=pref)[0] if x else 0
        most = max(sum(good[r[0]]) for r in g)
        out.add((t, i, first([r for r in g if sum(good[r[0]]) == most]), first([r for r in g if good[r[0]][0]]), first([r for r in g if good[r[0]][1]])))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_definition(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        rows.append((i, rng.choice([1, None]), rng.randrange(8), 0, rng.choice(["http://t/k/1", "http://t/k/2", None]), rng.choice(["Manual review", "manual-REVIEW", " Exact  occurrence", "x", None]),
                     rng.choice([0.0, 1.0, 0.5, 1.7, -0.1, float("nan"), None]), rng.choice(["zin", "-", "None", "", None, "geen"]), rng.choice([dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2), None])))
    rows += rows[:40]
    m = spark.createDataFrame(rows, SCHEMA).withColumn("concept", F.lit("clash")).withColumn("pattern", F.lit(1))
    t = spark.createDataFrame(TRUST, "source string, trust_rank int")
    got = s.survivors(m, t).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))
    merged = s.merged_records(m, t)
    assert merged.count() == len({(r[1], r[2], r[4]) for r in rows if r[4]})


def test_donors_equal_their_definition():
    rng = random.Random(1)
    for _ in range(300):
        pattern = rng.sample(range(8), rng.randint(1, 8))
        a, b, of_b, c, of_c = s.choose_donors(pattern)
        count = [bin(p).count("1") for p in pattern]
        assert a == min(range(len(pattern)), key=lambda i: (-count[i], i))
        assert b == of_b == next((i for i, p in enumerate(pattern) if p & 1), -1) and c == of_c == next((i for i, p in enumerate(pattern) if p & 2), -1)


def greedy(donors, worth):
    return tuple(max(d, key=w) if d else -1 for d, w in zip(donors, worth))


def keeps(chosen, codes, dependencies):
    return all(chosen[x] < 0 or chosen[y] < 0 or (codes[x][chosen[x]], codes[y][chosen[y]]) in set(zip(codes[x], codes[y])) for x, y in dependencies)


def test_search_equals_exhaustive_where_greedy_fails():
    """Street, postcode and town of three records: postcode determines town."""
    import itertools

    rng, lost = random.Random(2), 0
    for _ in range(400):
        n, k = rng.randint(1, 6), rng.randint(2, 4)
        donors = [[i for i in range(n) if rng.random() < 0.8] for _ in range(k)]
        trust = [[rng.randrange(4) for _ in range(n)] for _ in range(k)]
        worth = [lambda i, t=t: (t[i], -i) for t in trust]
        codes = [[rng.randrange(3) for _ in range(n)] for _ in range(k)]
        dependencies = sorted({tuple(rng.sample(range(k), 2)) for _ in range(rng.randint(1, 3))})
        value = lambda c: tuple(w(i) if i >= 0 else (float("-inf"),) for w, i in zip(worth, c))
        every = [c for c in itertools.product(*[d or [-1] for d in donors]) if keeps(c, codes, dependencies)]
        got = s.branch_and_bound(donors, worth, codes, dependencies)
        assert got == (max(every, key=value) if every else (-1,) * k)
        lost += not keeps(greedy(donors, worth), codes, dependencies)
    assert lost > 50


def test_the_most_trusted_origin_is_not_given_a_foreign_score():
    every = range(2)  # the preferred record 0 has no usable score
    worth = [lambda i: (1,), lambda i: (-i,)]
    assert greedy([[1], every], worth) == (1, 0)
    assert s.branch_and_bound([[1], every], worth, [every, every], [(1, 0)]) == (1, 1)


def test_empty_and_single(spark):
    t = spark.createDataFrame(TRUST, "source string, trust_rank int")
    m = spark.createDataFrame([(1, 1, 1, 0, "u", None, None, None, None)], SCHEMA)
    assert s.survivors(m, t).count() == 0 and s.survivors(m.limit(0), t).count() == 0
    r = s.merged_records(m, t.limit(0)).collect()
    assert len(r) == 1 and r[0].survivor_id == 1 and r[0].score is None and r[0].evidence is None


def test_time_zone_does_not_reorder(spark):
    hour = [dt.datetime(2023, 10, 29, 2, 30), dt.datetime(2023, 10, 29, 3, 59, 59, 999999), dt.datetime(2023, 3, 26, 2, 30, 0, 1), dt.datetime(2023, 3, 26, 2, 30)]
    rows = [(i, 1, i // 2, 0, "http://t/k/1", None, None, None, x) for i, x in enumerate(hour)]
    t = spark.createDataFrame(TRUST, "source string, trust_rank int")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
    try:
        got = {r.segment_idx: r.survivor_id for r in s.survivors(spark.createDataFrame(rows, SCHEMA), t).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {0: 1, 1: 2}
