"""Queries of the general problems with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talespan.operators import hierarchy as tree
from talespan.operators.intervals import segment_periods
from talespan.runtime import table


def _hierarchy(spark: SparkSession, d: str, paths: bool) -> DataFrame:
    return tree.hierarchy(*tree.concept_edges(table(spark, d, "concepts")), paths=paths)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _hierarchy(spark, d, False).select(F.col("id").alias("concept_idx"), F.col("root").alias("root_idx"), "depth", "n_descendants", "in_cycle")


def p3_paths(spark: SparkSession, d: str) -> DataFrame:
    """Full path of each concept from its root, as ids; empty where no root leads to it."""
    return _hierarchy(spark, d, True).select(F.col("id").alias("concept_idx"), F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


def p3_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of a concept and another concept below it."""
    return tree.descendants(*tree.concept_edges(table(spark, d, "concepts"))).select(F.col("a").alias("concept_idx"), F.col("d").alias("descendant_idx"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return segment_periods(table(spark, d, "segments"))


QUERIES = {f.__name__: f for f in (p3_found, p3_paths, p3_descendants, p5_found)}

_KEY = r"regexp_replace(regexp_replace(regexp_replace(lower(trim({0}, ' ' || chr(9) || chr(10))), '[?#].*$', ''), '^(https?:)?/*(www\.)?', ''), '/+$', '')"
_EDGES = f"""
WITH RECURSIVE n AS (SELECT DISTINCT concept_idx AS id, {_KEY.format('uri')} AS k FROM concepts),
l AS (SELECT DISTINCT concept_idx AS p, {_KEY.format('x')} AS k FROM (SELECT concept_idx, unnest(narrower) AS x FROM concepts)),
e AS (SELECT DISTINCT l.p, n.id AS c FROM l JOIN n USING (k)),
reach(a, d) AS (SELECT p, c FROM e UNION SELECT reach.a, e.c FROM reach JOIN e ON e.p = reach.d)"""

ORACLES = {
    "p3_found": _EDGES + """,
down(root, id, depth) AS (
  SELECT id, id, 0 FROM n WHERE id NOT IN (SELECT c FROM e)
  UNION SELECT down.root, e.c, down.depth + 1 FROM down JOIN e ON e.p = down.id WHERE down.depth < (SELECT count(*) FROM n)),
near AS (SELECT id, min(struct_pack(depth := depth, root := root)) AS s FROM down GROUP BY id)
SELECT n.id AS concept_idx, coalesce(near.s.root, -1) AS root_idx, coalesce(near.s.depth, -1) AS depth,
       CAST((SELECT count(*) FROM reach WHERE a = n.id AND d <> n.id) AS INTEGER) AS n_descendants,
       CAST((SELECT count(*) FROM reach WHERE a = n.id AND d = n.id) AS INTEGER) AS in_cycle
FROM n LEFT JOIN near ON near.id = n.id""",
    "p3_paths": _EDGES + """,
down(root, id, path) AS (
  SELECT id, id, [id] FROM n WHERE id NOT IN (SELECT c FROM e)
  UNION ALL SELECT down.root, e.c, list_append(down.path, e.c) FROM down JOIN e ON e.p = down.id WHERE NOT list_contains(down.path, e.c)),
best AS (SELECT id, min(struct_pack(n := len(path), root := root, path := path)) AS s FROM down GROUP BY id)
SELECT n.id AS concept_idx, coalesce(array_to_string(best.s.path, '/'), '') AS path FROM n LEFT JOIN best ON best.id = n.id""",
    "p3_descendants": _EDGES + " SELECT a AS concept_idx, d AS descendant_idx FROM reach WHERE a <> d",
    "p5_found": """
WITH v AS (SELECT DISTINCT transcript_id, tape_no, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e
           FROM segments WHERE start_s IS NOT NULL AND end_s IS NOT NULL AND end_s > start_s),
b AS (SELECT *, max(e) OVER (PARTITION BY transcript_id, tape_no ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id, tape_no ORDER BY s, e) AS grp FROM b),
p AS (SELECT transcript_id, tape_no, grp, min(s) AS s, max(e) AS e FROM g GROUP BY ALL)
SELECT transcript_id, tape_no, 'period' AS kind, s AS start_ms, e AS end_ms FROM p
UNION ALL
SELECT transcript_id, tape_no, 'gap', e, nxt FROM (SELECT *, lead(s) OVER (PARTITION BY transcript_id, tape_no ORDER BY s) AS nxt FROM p) WHERE nxt IS NOT NULL""",
}
