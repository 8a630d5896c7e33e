"""Problem 2: best representative of each duplicate group.

Method: consistent bundles. Dependent fields form bundles that are taken whole from one record:
identity (match id, position, uri), score, the score's origin (source, time), evidence, the
evidence's origin. Functional dependencies couple them: an origin determines the score and the
evidence that stand with it, so a score may not be shown with the origin of another record. A
branch-and-bound search assigns a donor record to each bundle, maximising completeness and trust
among the assignments that break no dependency. Taking the best donor of each bundle alone would
pair the most trusted origin with a score that it never gave.

Scale: the objective depends only on which of the three checked fields a record has usable and
on its preference, a total order, and the dependencies tie donors by record. So a hash aggregation
with map-side combine first keeps, per group and usability pattern, the preferred record: at most
eight candidates, however large a group is. The search runs on those. Merged records fetch their
donors' fields by match_id afterwards, so full rows are no part of the aggregation.

Cases: null, NaN or out-of-range scores, stand-in evidence and unknown sources are unusable;
a null or unreadable uri forms no group; null segment keys form groups of their own; ties fall
to the smaller match_id; rows delivered twice (same match_id) count once; groups of one record
give no row in ``survivors``; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from talespan.functions.uris import uri_form

# Stand-ins for "no evidence"; between their letters any signs and blanks may stand.
STAND_INS = ("none", "na", "geen", "nvt", "onbekend", "null", "nan", "unknown", "unbekannt", "keine", "nihil", "nil", "tbd", "leeg", "empty",
             "nietbekend", "notavailable", "notapplicable", "ka")
_SIGNS = r"[^\p{L}\p{N}]*"
_EMPTY = f"(?i)^{_SIGNS}(?:(?:" + "|".join(_SIGNS.join(w) for w in STAND_INS) + f"){_SIGNS})?$"
BUNDLES = ("survivor", "score", "score_origin", "evidence", "evidence_origin")
#: (determining bundle, determined bundle), by place in BUNDLES.
DEPENDENCIES = ((2, 1), (4, 3))
_UNKNOWN_RANK = 1_000_000


def source_key(source: Column) -> Column:
    """A source name without case, blanks and punctuation."""
    return F.regexp_replace(F.lower(source), r"[^\p{L}\p{N}]+", "")


def evidence_says(evidence: Column) -> Column:
    """Whether an evidence text says something: it holds a letter or digit and is no stand-in."""
    return F.coalesce(~evidence.rlike(_EMPTY), F.lit(False))


Worth = Callable[[int], tuple]


def branch_and_bound(donors: Sequence[Sequence[int]], worth: Sequence[Worth], codes: Sequence[Sequence[int]], dependencies: Sequence[tuple[int, int]]) -> tuple[int, ...]:
    """The donor record of each bundle, -1 for none.

    ``donors``: per bundle the records that may supply it; ``worth``: per bundle what a donor
    is worth, compared bundle by bundle in order; ``codes``: per bundle a code of each record's
    values, equal where the values are; ``dependencies``: (x, y) pairs, bundle x determines
    bundle y. An assignment keeps a dependency if some record has both the values chosen for x and
    those chosen for y; a bundle without donor breaks none.

    Bundles are assigned in order, donors of most worth first. A branch is left when its bound,
    what it has plus the most that the open bundles could be worth if no dependency held, does
    not exceed the best found; a donor that breaks a dependency with an earlier one is passed over.
    """
    n = len(donors)
    ordered = [sorted(d, key=worth[b], reverse=True) for b, d in enumerate(donors)]
    none = (float("-inf"),)
    bound = tuple(worth[b](d[0]) if d else none for b, d in enumerate(ordered))
    holds = {(x, y): set(zip(codes[x], codes[y])) for x, y in dependencies}
    checks = [[(x, y) for x, y in dependencies if max(x, y) == b] for b in range(n)]
    best_value, best = None, (-1,) * n

    def branch(b: int, chosen: tuple, value: tuple) -> None:
        nonlocal best_value, best
        if b == n:
            if best_value is None or value > best_value:
                best_value, best = value, chosen
            return
        for i in ordered[b] or [-1]:
            got = (*value, worth[b](i) if i >= 0 else none)
            if best_value is not None and got + bound[b + 1:] <= best_value:
                break  # donors of less worth are bounded too
            now = (*chosen, i)
            if all(now[x] < 0 or now[y] < 0 or (codes[x][now[x]], codes[y][now[y]]) in holds[x, y] for x, y in checks[b]):
                branch(b + 1, now, got)

    branch(0, (), ())
    return best


def choose_donors(patterns: Sequence[int]) -> tuple[int, ...]:
    """Donors of BUNDLES for one group whose candidates come in preference order. ``patterns``:
    bits 1 score, 2 evidence, 4 source usable. The survivor is worth its usable fields, then its
    preference; a score or evidence is worth that it is usable, and its origin the preference."""
    every = range(len(patterns))
    usable = [bin(p).count("1") for p in patterns]
    score, evidence = [i for i in every if patterns[i] & 1], [i for i in every if patterns[i] & 2]
    there, preferred = (lambda i: (1,)), (lambda i: (-i,))
    return branch_and_bound([every, score, every if score else [], evidence, every if evidence else []],
                            [lambda i: (usable[i], -i), there, preferred, there, preferred], [every] * len(BUNDLES), DEPENDENCIES)


_CHOSEN = StructType([StructField(b, LongType()) for b in BUNDLES])


@F.pandas_udf(_CHOSEN)
def _choose(patterns: pd.Series, ids: pd.Series) -> pd.DataFrame:
    """Candidates come in preference order, so the position is the preference."""
    out, known = np.zeros((len(patterns), len(BUNDLES)), np.int64), {}
    for k, (p, m) in enumerate(zip(patterns, ids)):
        key = tuple(p)
        got = known.get(key)
        if got is None:
            got = known[key] = choose_donors([int(x) for x in key])
        out[k] = [m[i] if i >= 0 else 0 for i in got]
    return pd.DataFrame(out, columns=list(BUNDLES))


def _prepared(matches: DataFrame, trust: DataFrame) -> DataFrame:
    """Records with concept, usability pattern and preference struct (smaller is preferred).
    The trust list has one row per source key; it is broadcast after a check of its size."""
    ranks = trust.where("source IS NOT NULL").groupBy(source_key(F.col("source")).alias("t_key")).agg(F.min("trust_rank").alias("trust_rank"))
    if ranks.count() <= 10_000:
        ranks = F.broadcast(ranks)
    m = matches.select("match_id", "transcript_id", "segment_idx", "uri", "source", "score", "evidence", "scored_at",
                       uri_form(F.col("uri")).alias("concept"), source_key(F.col("source")).alias("s_key"))
    m = m.where("uri IS NOT NULL AND match_id IS NOT NULL").join(ranks, F.col("s_key") == F.col("t_key"), "left")
    score_ok = F.coalesce(~F.isnan("score") & F.col("score").between(0, 1), F.lit(False))
    pattern = (F.when(score_ok, 1).otherwise(0) + F.when(evidence_says(F.col("evidence")), 2).otherwise(0)
               + F.when(F.col("trust_rank").isNotNull(), 4).otherwise(0)).cast("int")
    # Microseconds by calendar fields, so that no session time zone can reorder times.
    at = F.col("scored_at")
    micros = (F.datediff(at, F.lit("1970-01-01")).cast("bigint") * 86_400_000_000 + F.hour(at).cast("bigint") * 3_600_000_000 + F.minute(at).cast("bigint") * 60_000_000
              + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint"))
    late = F.when(at.isNull(), F.lit(0)).otherwise(-micros - F.lit(1 << 61))
    preference = F.struct(F.coalesce("trust_rank", F.lit(_UNKNOWN_RANK)).alias("rank"), late.alias("late"), F.col("match_id").alias("id"))
    return m.select("transcript_id", "segment_idx", "concept", "match_id", pattern.alias("pattern"), preference.alias("preference"))


def survivors(matches: DataFrame, trust: DataFrame) -> DataFrame:
    """Per group of two or more records of one segment and concept: transcript_id,
    segment_idx, survivor_id, score_id, evidence_id (0 where no record is usable)."""
    group = ["transcript_id", "segment_idx", "concept"]
    best = (_prepared(matches, trust).groupBy(*group, "pattern")
            .agg(F.min("preference").alias("p"), F.min("match_id").alias("low"), F.max("match_id").alias("high")))
    # The form's length is an aggregate, so the test for empty forms is not copied into the scan.
    found = best.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("p", "pattern"))).alias("c"), F.min("low").alias("low"), F.max("high").alias("high"), F.max(F.length("concept")).alias("form")
    ).where("low <> high AND form > 0")
    chosen = found.select("transcript_id", "segment_idx", _choose(F.col("c.pattern"), F.col("c.p.id")).alias("x"))
    return chosen.select("transcript_id", "segment_idx", F.col("x.survivor").alias("survivor_id"),
                         F.col("x.score").alias("score_id"), F.col("x.evidence").alias("evidence_id"))


def merged_records(matches: DataFrame, trust: DataFrame) -> DataFrame:
    """Every group's surviving record built from whole bundles, groups of one included: the
    survivor's identity, the score with the source it stands with, the evidence likewise (null
    where none is usable), and the number of records."""
    group = ["transcript_id", "segment_idx", "concept"]
    # One narrow row per record; groups and patterns are then combined before they are shuffled.
    once = _prepared(matches, trust).groupBy(*group, "match_id").agg(F.min(F.struct("preference", "pattern")).alias("r"))
    best = once.groupBy(*group, F.col("r.pattern").alias("pattern")).agg(F.min("r.preference").alias("p"), F.count("*").alias("n"))
    found = best.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("p", "pattern"))).alias("c"), F.sum("n").alias("n_records"), F.max(F.length("concept")).alias("form")).where("form > 0")
    x = found.select(*group, "n_records", _choose(F.col("c.pattern"), F.col("c.p.id")).alias("x")).select(*group, "n_records", "x.*")
    # Each donor once, with the roles it plays; its fields are fetched by match_id.
    roles = F.array(*[F.struct(F.col(b).alias("match_id"), F.lit(b).alias("role")) for b in BUNDLES])
    wanted = x.select(*group, "n_records", F.col("survivor").alias("survivor_id"), F.explode(roles).alias("d")).where("d.match_id <> 0 OR d.role = 'survivor'")
    wanted = wanted.groupBy(*group, "n_records", "survivor_id", F.col("d.match_id").alias("match_id")).agg(*[F.bool_or(F.col("d.role") == b).alias("for_" + b) for b in BUNDLES])
    record = matches.select("match_id", "match_idx", "source", "scored_at", "score", "evidence").where("match_id IS NOT NULL")
    joined = wanted.join(record, "match_id")
    of = lambda role, c: F.max(F.when(F.col("for_" + role), F.col(c)))
    return joined.groupBy(*group, "survivor_id").agg(
        of("survivor", "match_idx").alias("match_idx"), of("survivor", "source").alias("source"), of("survivor", "scored_at").alias("scored_at"),
        of("score", "score").alias("score"), of("score_origin", "source").alias("score_source"), of("evidence", "evidence").alias("evidence"),
        of("evidence_origin", "source").alias("evidence_source"), F.max("n_records").cast("bigint").alias("n_records"))
