"""DuckDB SQL of those queries in queries.py that SQL can express."""

from talespan.llm.canonical import GENERAL

_CLEAN_URI = r"""regexp_replace(regexp_replace(regexp_replace(lower(url_decode(regexp_replace(lower(regexp_replace(uri, '^[\s<]+|[\s>]+$', '', 'g')), '[?#].*$', ''))), '^(https?:)?/*(www\.)?', ''), '/{2,}', '/', 'g'), '/+$', '')"""

_P2 = rf"""
WITH t AS (SELECT regexp_replace(lower(source), '[^\p{{L}}\p{{N}}]+', '', 'g') AS k, min(trust_rank) AS trust_rank FROM source_trust GROUP BY 1),
m AS (SELECT DISTINCT match_id, transcript_id, segment_idx, match_idx, {_CLEAN_URI} AS concept, score, evidence, source, scored_at FROM matches),
r AS (
  SELECT m.match_id, transcript_id, segment_idx, match_idx, concept, score, evidence, source, coalesce(trust_rank, 1000000) AS tr, scored_at,
         CASE WHEN score IS NOT NULL AND NOT isnan(score) AND score >= 0 AND score <= 1 THEN 1 ELSE 0 END AS s_ok,
         CASE WHEN regexp_matches(evidence, '[\p{{L}}\p{{N}}]') AND lower(trim(evidence)) NOT IN ('none', 'n/a', 'geen', 'n.v.t.', 'null', 'onbekend') THEN 1 ELSE 0 END AS e_ok,
         CASE WHEN trust_rank IS NOT NULL THEN 1 ELSE 0 END AS t_ok
  FROM m LEFT JOIN t ON regexp_replace(lower(m.source), '[^\p{{L}}\p{{N}}]+', '', 'g') = t.k),
p AS (SELECT *, row_number() OVER (PARTITION BY transcript_id, segment_idx, concept ORDER BY tr, scored_at DESC NULLS LAST, match_id) AS pref FROM r)
"""

# A plain form of problem 1: general words removed, letters joined, distance to every name.
_GENERAL = "', '".join(sorted(GENERAL))
_SQUEEZE = f"""array_to_string(list_filter(regexp_extract_all(regexp_replace(strip_accents(lower({{0}})), '\\b((?:[a-z]\\.)+[a-z]?)', replace(regexp_extract(strip_accents(lower({{0}})), '\\b((?:[a-z]\\.)+[a-z]?)', 1), '.', '')), '[a-z]+'),
  lambda w: w NOT IN ('{_GENERAL}')), '')"""
_P1 = f"""
WITH n AS (SELECT uri, unnest(list_concat([name], coalesce(alternate_names, []))) AS name FROM ref_concepts),
r AS (SELECT DISTINCT uri, {_SQUEEZE.format('name')} AS form FROM n WHERE name IS NOT NULL),
l AS (SELECT DISTINCT transcript_id, segment_idx, unnest(regexp_split_to_array(text, '[\\n\\r]')) AS line FROM segments WHERE seg_type = 'keyword'),
p AS (SELECT transcript_id, segment_idx, unnest(regexp_split_to_array(regexp_replace(trim(line, chr(9) || ' "''#'), '(?i)^\\s*(trefwoord|keyword|tw|plaats/onderwerp|thema)\\s*[:–]\\s*', ''), '[;|+/,]')) AS piece FROM l),
v AS (SELECT DISTINCT transcript_id, segment_idx, trim(piece, chr(9) || ' "''“”„#?!.-–') AS value FROM p),
f AS (SELECT *, {_SQUEEZE.format('value')} AS form FROM v),
u AS (SELECT DISTINCT form FROM f WHERE form <> ''),
d AS (SELECT u.form, r.uri, damerau_levenshtein(u.form, r.form) AS dist FROM u JOIN r ON abs(length(u.form) - length(r.form)) <= 2),
b AS (SELECT form, uri FROM d WHERE dist <= CASE WHEN length(form) <= 3 THEN 0 WHEN length(form) <= 5 THEN 1 ELSE 2 END QUALIFY dist = min(dist) OVER (PARTITION BY form)),
o AS (SELECT f.transcript_id, f.segment_idx, f.value, CASE WHEN f.form = '' THEN 'no name' ELSE coalesce(b.uri, 'unmatched') END AS uri FROM f LEFT JOIN b USING (form)
      WHERE regexp_matches(f.value, '[\\p{{L}}\\p{{N}}]'))
"""

ORACLES = {
    "p1_found": _P1 + "SELECT DISTINCT transcript_id, segment_idx, uri FROM o WHERE uri <> 'no name'",
    "p1_unmatched": _P1 + "SELECT lower(value) AS value, uri AS kind, count(DISTINCT (transcript_id, segment_idx)) AS n_segments FROM o WHERE uri IN ('unmatched', 'no name') GROUP BY ALL",
    "p2_merged": _P2 + """,
g AS (SELECT transcript_id, segment_idx, concept, count(*) AS n_records,
       arg_min(struct_pack(id := match_id, i := match_idx, s := source, at := scored_at), pref - 1000000 * (s_ok + e_ok + t_ok)) AS best,
       arg_min(struct_pack(v := score, s := source), pref) FILTER (WHERE s_ok = 1) AS sc, arg_min(struct_pack(v := evidence, s := source), pref) FILTER (WHERE e_ok = 1) AS ev
FROM p GROUP BY transcript_id, segment_idx, concept)
SELECT transcript_id, segment_idx, concept, best.id AS survivor_id, best.i AS match_idx, best.s AS source, best.at AS scored_at, sc.v AS score, sc.s AS score_source, ev.v AS evidence, ev.s AS evidence_source, n_records FROM g""",
    "p2_found": _P2 + """
SELECT transcript_id, segment_idx,
       arg_min(match_id, pref - 1000000 * (s_ok + e_ok + t_ok)) AS survivor_id,
       coalesce(arg_min(match_id, pref) FILTER (WHERE s_ok = 1), 0) AS score_id,
       coalesce(arg_min(match_id, pref) FILTER (WHERE e_ok = 1), 0) AS evidence_id
FROM p GROUP BY transcript_id, segment_idx, concept HAVING count(*) > 1""",
}
