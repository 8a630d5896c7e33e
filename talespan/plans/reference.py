"""Queries of the engine's own operators with DuckDB SQL.

Fixtures are SQL texts that both engines run on the given tables: table names stand in braces,
so Spark binds data frames to them and DuckDB reads its views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talespan.backends.chat import RuleBackend
from talespan.backends.embed import HashingEmbedder, embed
from talespan.functions import prompts, text as tx, vectors as vec
from talespan.functions.uris import uri_key
from talespan.functions.tokens import CharacterCounter, RankCounter, token_count
from talespan.operators import batching, matching as m, segmentation as seg, segments as sg, thesaurus as th
from talespan.operators.topdown import match_topdown
from talespan.plans import pipeline
from talespan.runtime import materialize, release, stage_path, table
from talespan.sinks import documents as sink
from talespan.sources import incremental, ntriples, vtt

TAPE = ["transcript_id", "tape_no"]
SEG = ["transcript_id", "segment_idx"]
_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "captions", "segments", "speakers",
          "matches", "concepts", "ref_concepts", "source_trust", "token_limits"]

# --- fixtures, valid in both engines -----------------------------------------------------------

CAPTIONS = """SELECT DISTINCT transcript_id, tape_no, caption_idx, text, start_ms, end_ms,
  CAST(start_ms AS DOUBLE) / CAST(1000 AS DOUBLE) AS "start", CAST(end_ms AS DOUBLE) / CAST(1000 AS DOUBLE) AS "end"
FROM {captions} WHERE text IS NOT NULL AND start_ms IS NOT NULL AND end_ms IS NOT NULL"""
BOUNDARIES = "SELECT DISTINCT transcript_id, tape_no, caption_idx FROM {captions} WHERE text LIKE '%?' AND start_ms IS NOT NULL AND end_ms IS NOT NULL"
SEGMENTS = """SELECT DISTINCT transcript_id, tape_no, segment_idx, start_s AS "start", end_s AS "end", text FROM {segments}
WHERE text IS NOT NULL"""
RAW = """SELECT concept_idx AS k, name, CASE concept_idx % 5
  WHEN 0 THEN concat('```json', chr(10), '[{{"concept":"', name, '","score":0.8}}]', chr(10), '```')
  WHEN 1 THEN concat('```', '[{{"concept":"', name, '","score":"0.6"}}]', '```')
  WHEN 2 THEN concat('<think>[x]</think> ["', name, '", "', name, '"]')
  WHEN 3 THEN concat('  [{{"concept":" ', name, ' ","score":null}}, {{"concept":"', name, '","score":0.25}}, 7, {{"score":1}}] ')
  ELSE concat('{{"concept":"', name, '"') END AS raw FROM {ref_concepts}"""
NAME_RAW = """SELECT transcript_id, tape_no, speaker_no, full_name, CASE (transcript_id + speaker_no) % 4
  WHEN 0 THEN concat('[{{"name":"', full_name, '"}}]') WHEN 1 THEN concat('{{"name":"', full_name, '"}}')
  WHEN 2 THEN concat('```json', chr(10), '[{{"role":1}}, {{"name":"', full_name, '"}}]', chr(10), '```') ELSE '[]' END AS raw FROM {speakers}"""
TRIPLES = """SELECT concat('r:', r_regionkey) AS s, 'type' AS p, 'Concept' AS o, CAST(NULL AS VARCHAR(8)) AS lang FROM {region}
UNION ALL SELECT concat('r:', r_regionkey), 'topConceptOf', 'scheme:main', NULL FROM {region}
UNION ALL SELECT concat('r:', r_regionkey), 'prefLabel', r_name, 'nl' FROM {region}
UNION ALL SELECT concat('r:', n_regionkey), 'narrower', concat('n:', n_nationkey), NULL FROM {nation}
UNION ALL SELECT concat('n:', n_nationkey), 'type', 'Concept', NULL FROM {nation}
UNION ALL SELECT concat('n:', n_nationkey), 'prefLabel', n_name, CASE WHEN n_nationkey % 5 = 4 THEN 'en' ELSE 'nl' END FROM {nation}
UNION ALL SELECT concat('n:', n_nationkey), 'scopeNote', concat('note ', n_nationkey), NULL FROM {nation} WHERE n_nationkey % 2 = 1
UNION ALL SELECT concat('n:', n_nationkey), 'altLabel', concat('alt ', n_nationkey), 'en' FROM {nation} WHERE n_nationkey % 3 = 0
UNION ALL SELECT concat('n:', n_nationkey), 'excludeFlag', ' False ', NULL FROM {nation} WHERE n_nationkey % 7 = 0
UNION ALL SELECT concat('n:', n_nationkey), 'inScheme', 'scheme:technical', NULL FROM {nation} WHERE n_nationkey % 11 = 5
UNION ALL SELECT concat('n:', n_nationkey), 'inScheme', 'scheme:camps', NULL FROM {nation} WHERE n_nationkey % 4 = 0
UNION ALL SELECT concat('n:', n_nationkey), 'inScheme', 'scheme:locations', NULL FROM {nation} WHERE n_nationkey % 6 = 0
UNION ALL SELECT concat('c:', concept_idx), 'type', 'Concept', NULL FROM {concepts}
UNION ALL SELECT concat('c:', concept_idx), 'prefLabel', name, 'nl' FROM {concepts} WHERE name IS NOT NULL
UNION ALL SELECT concat('c:', concept_idx), 'scopeNote', description, NULL FROM {concepts} WHERE description IS NOT NULL
UNION ALL SELECT concat('c:', concept_idx), 'inScheme', concat('scheme:', category, 's'), NULL FROM {concepts} WHERE category IS NOT NULL"""
VOCABULARY = th.Vocabulary(type="type", concept="Concept", in_scheme="inScheme", top_of="topConceptOf", narrower="narrower", pref_label="prefLabel", alt_label="altLabel",
                           note="scopeNote", flag="excludeFlag", excluded_scheme="scheme:technical", camp_scheme="scheme:camps", location_scheme="scheme:locations")


def both(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """A fixture in Spark."""
    used = {n: table(spark, d, n) for n in _NAMES if "{" + n + "}" in sql}
    return spark.sql(sql.replace('"start"', "`start`").replace('"end"', "`end`"), **used)


def duck(sql: str) -> str:
    """The same fixture as DuckDB text."""
    return sql.format(**{n: n for n in _NAMES})


# Matches with the uri and name of their reference entry, however the uri is spelled; every match_id is kept.
_URI_SQL = r"""regexp_replace(regexp_replace(regexp_replace(lower(url_decode(regexp_replace(lower(regexp_replace({0}, '^[\s<]+|[\s>]+$', '', 'g')), '[?#].*$', ''))), '^(https?:)?/*(www\.)?', ''), '/{{2,}}', '/', 'g'), '/+$', '')"""
C, B, S = duck(CAPTIONS), duck(BOUNDARIES), duck(SEGMENTS)
M = f"""SELECT DISTINCT x.match_id, x.transcript_id, x.segment_idx, x.match_idx, coalesce(r.uri, x.uri) AS uri, r.name, x.source, CASE WHEN isnan(x.score) THEN NULL ELSE x.score END AS score
FROM matches x LEFT JOIN (SELECT {_URI_SQL.format('uri')} AS k, min(uri) AS uri, min(name) AS name FROM ref_concepts GROUP BY 1) r ON {_URI_SQL.format('x.uri')} = r.k"""
ITEMS = f"""SELECT transcript_id, segment_idx, name AS concept, CASE WHEN min(match_idx) % 3 = 0 THEN NULL ELSE CAST(0.25 AS DOUBLE) * (min(match_idx) % 4) END AS score
FROM ({M}) WHERE name IS NOT NULL GROUP BY transcript_id, segment_idx, name"""


def _matches(spark: SparkSession, d: str) -> DataFrame:
    """The rows of M."""
    named = table(spark, d, "ref_concepts").groupBy(uri_key(F.col("uri")).alias("k")).agg(F.min("uri").alias("r_uri"), F.min("name").alias("name"))
    x = table(spark, d, "matches").withColumn("k", uri_key(F.col("uri"))).join(named, "k", "left")
    return x.select("match_id", *SEG, "match_idx", F.coalesce("r_uri", "uri").alias("uri"), "name", "source", F.when(~F.isnan("score"), F.col("score")).alias("score")).distinct()


def _items(spark: SparkSession, d: str) -> DataFrame:
    """The rows of ITEMS: one answer per segment and name, which may fit several matches."""
    first = _matches(spark, d).where("name IS NOT NULL").groupBy(*SEG, F.col("name").alias("concept")).agg(F.min("match_idx").alias("i"))
    return first.select(*SEG, "concept", F.when(F.col("i") % 3 != 0, F.col("i") % 4 * F.lit(0.25)).alias("score"))


_STRIP = r"regexp_replace({0}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"
_FLAT = _STRIP.format("replace(text, chr(10), ' ')")

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


# --- sources and sinks -------------------------------------------------------------------------

_FILES = "SELECT DISTINCT concat('t', transcript_id, '_', tape_no, CASE WHEN tape_no = 3 THEN '.txt' ELSE '.vtt' END) AS file_name FROM {captions}"
_DONE = "SELECT DISTINCT concat('t', transcript_id, '_1_enriched_segments.json') AS file_name FROM {documents} WHERE transcript_id IS NOT NULL"


@query(f"""SELECT file_name FROM ({duck(_FILES)}) WHERE file_name LIKE '%.vtt'
AND replace(file_name, '.vtt', '_enriched_segments.json') NOT IN (SELECT file_name FROM ({duck(_DONE)}))""")
def incremental_antijoin(spark, d):
    return incremental.new_inputs(both(spark, d, _FILES), both(spark, d, _DONE))


def _stamp(ms):
    part = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return F.concat(part(F.floor(ms / 3600000), 2), F.lit(":"), part(F.floor(ms / 60000) % 60, 2), F.lit(":"), part(F.floor(ms / 1000) % 60, 2), F.lit("."), part(ms % 1000, 3))


def _seconds_sql(ms: str) -> str:
    return f"CAST(({ms} // 3600000) * 3600 + ({ms} // 60000 % 60) * 60 + ({ms} // 1000 % 60) AS DOUBLE) + CAST({ms} % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)"


@query(f"""SELECT transcript_id, tape_no, caption_idx, {_seconds_sql('start_ms')} AS start_s, {_seconds_sql('end_ms')} AS end_s
FROM ({C}) WHERE start_ms >= 0 AND end_ms >= 0""")
def vtt_timestamp(spark, d):
    cap = both(spark, d, CAPTIONS).where("start_ms >= 0 AND end_ms >= 0")
    line = F.concat(_stamp(F.col("start_ms")), F.lit(" --> "), _stamp(F.col("end_ms")))
    return cap.withColumn("t", tx.cue_times(line)).select(*TAPE, "caption_idx", F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"))


_CUES = "SELECT DISTINCT transcript_id, tape_no, caption_idx, text, start_ms, end_ms FROM {captions}"


def _vtt_files(spark, d):
    """One WebVTT file per tape from all captions, as they are: a caption without times is text
    without a timing line, one without text is a timing line alone; texts stand on one line."""
    timed = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    timing = F.when(timed, F.concat(_stamp(F.col("start_ms")), F.lit(" --> "), _stamp(F.col("end_ms")), F.lit("\n"))).otherwise("")
    said = F.when(F.col("text").rlike(r"(?U)\S"), F.concat(F.regexp_replace("text", r"(?U)\s+", " "), F.lit("\n"))).otherwise("")
    docs = both(spark, d, _CUES).groupBy(*TAPE).agg(F.array_sort(F.collect_list(F.struct("caption_idx", F.concat(timing, said, F.lit("\n")).alias("c")))).alias("x"))
    return docs.select(F.concat(F.lit("t"), F.col("transcript_id"), F.lit("_"), F.col("tape_no"), F.lit(".vtt")).alias("file_name"),
                       F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform("x", lambda r: r["c"]), "")).alias("value"))


# The parser as a fold over captions: pending is 't' after a time without text, 'x' after text without a time. A text
# with an arrow is no timing, so its whole file is an error.
@query(rf"""WITH RECURSIVE q AS (SELECT *, start_ms IS NOT NULL AND end_ms IS NOT NULL AS t, coalesce(regexp_matches(text, '[^\s\x{{a0}}]'), false) AS x FROM ({duck(_CUES)})),
o AS (SELECT *, row_number() OVER (PARTITION BY transcript_id, tape_no ORDER BY caption_idx) AS r FROM q
  WHERE (transcript_id, tape_no) NOT IN (SELECT (transcript_id, tape_no) FROM q WHERE x AND contains(text, '-->'))),
f AS (SELECT transcript_id, tape_no, 0::BIGINT AS r, '' AS pending, NULL::BIGINT AS s, NULL::BIGINT AS e, false AS out FROM o WHERE r = 1
  UNION ALL SELECT o.transcript_id, o.tape_no, o.r,
    CASE WHEN (o.t OR f.pending = 't') AND (o.x OR f.pending = 'x') THEN '' WHEN o.t OR f.pending = 't' THEN 't' WHEN o.x OR f.pending = 'x' THEN 'x' ELSE '' END,
    CASE WHEN o.t THEN o.start_ms WHEN f.pending = 't' THEN f.s END, CASE WHEN o.t THEN o.end_ms WHEN f.pending = 't' THEN f.e END,
    (o.t OR f.pending = 't') AND (o.x OR f.pending = 'x') FROM f JOIN o ON o.transcript_id = f.transcript_id AND o.tape_no = f.tape_no AND o.r = f.r + 1)
SELECT concat('t', transcript_id, '_', tape_no, '.vtt') AS file_name, CAST(row_number() OVER (PARTITION BY transcript_id, tape_no ORDER BY r) - 1 AS INTEGER) AS caption_idx,
{_seconds_sql('s')} AS start_s, {_seconds_sql('e')} AS end_s FROM f WHERE out""")
def vtt_parse(spark, d):
    got = vtt.parse_files(_vtt_files(spark, d))
    return got.where("error IS NULL").select("file_name", "caption_idx", F.col("start").alias("start_s"), F.col("end").alias("end_s"))


@query()
def vtt_texts(spark, d):
    """Parsed captions with their repaired texts."""
    return vtt.parse_files(_vtt_files(spark, d))


@query(f"SELECT DISTINCT s, p, o, CASE WHEN lang IS NULL AND p IN ('type', 'topConceptOf', 'narrower', 'inScheme') THEN 'iri' ELSE 'literal' END AS o_kind, lang FROM ({duck(TRIPLES)})")
def ntriples_scan(spark, d):
    t = both(spark, d, TRIPLES)
    escaped = F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\\\\\"), '"', r'\\\\"')
    literal = F.concat(F.lit('"'), escaped, F.lit('"'), F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), F.col("lang"))).otherwise(F.lit("")))
    iri = F.concat(F.lit("<"), F.col("o"), F.lit(">"))
    is_iri = F.col("lang").isNull() & F.col("p").isin("type", "topConceptOf", "narrower", "inScheme")
    lines = t.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), F.when(is_iri, iri).otherwise(literal), F.lit(" .")).alias("value"))
    return ntriples.parse_triples(lines).select("s", "p", "o", "o_kind", "lang")


@query(f"""SELECT transcript_id, tape_no, to_json(list(struct_pack("start" := "start", "end" := "end", text := text) ORDER BY segment_idx)) AS json FROM ({S}) GROUP BY transcript_id, tape_no""")
def serialize_segments(spark, d):
    return sink.serialize_segments(both(spark, d, SEGMENTS), TAPE)


def _enriched(spark, d):
    segments = both(spark, d, SEGMENTS)
    matches = _matches(spark, d).drop("name").withColumn("match_idx", F.col("match_id"))
    names = both(spark, d, "SELECT DISTINCT transcript_id, full_name AS name FROM {speakers} WHERE speaker_no = 2 AND tape_no = 1")
    names = names.groupBy("transcript_id").agg(F.min("name").alias("name"))
    return sink.enrich_rows(segments, matches, table(spark, d, "ref_concepts"), names, ["transcript_id"])


_ENRICHED_SQL = f"""SELECT s.transcript_id, s.segment_idx, n.name AS interviewee_name, s."start" AS start_s, s."end" AS end_s, s.text,
  coalesce(to_json(m.l), '[]') AS matched
FROM ({S}) s LEFT JOIN (SELECT transcript_id, min(full_name) AS name FROM speakers WHERE speaker_no = 2 AND tape_no = 1 GROUP BY 1) n USING (transcript_id)
LEFT JOIN (SELECT transcript_id, segment_idx, list(struct_pack(uri := uri, name := name, source := source, score := score) ORDER BY match_id) AS l FROM ({M}) GROUP BY ALL) m
USING (transcript_id, segment_idx)"""


def _as_json(rows):
    return rows.select("transcript_id", "segment_idx", "interviewee_name", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "text",
                       F.to_json("matched_concepts", {"ignoreNullFields": "false"}).alias("matched"))


@query(_ENRICHED_SQL)
def serialize_enriched(spark, d):
    return _as_json(_enriched(spark, d))


@query(_ENRICHED_SQL)
def json_roundtrip(spark, d):
    """Enriched segments written as JSON lines by transcript and read again."""
    rows = _enriched(spark, d)
    path = stage_path(spark, "json-roundtrip")
    sink.write_partitioned(rows, path, "transcript_id")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return _as_json(spark.read.schema(schema).json(path))


# --- labels and prompts --------------------------------------------------------------------------


@query("SELECT concept_idx, CASE WHEN coalesce(description, '') <> '' THEN concat(name, ' – ', description) ELSE name END AS label FROM ref_concepts")
def concept_label(spark, d):
    return table(spark, d, "ref_concepts").select("concept_idx", tx.concept_label(F.col("name"), F.col("description")).alias("label"))


@query("""SELECT concept_idx, concat_ws(' | ', name, CASE WHEN len(alternate_names) > 0 THEN array_to_string(alternate_names, ' / ') END, nullif(description, '')) AS label
FROM ref_concepts""")
def concept_text(spark, d):
    return table(spark, d, "ref_concepts").select("concept_idx", tx.concept_text(F.col("name"), F.col("alternate_names"), F.col("description")).alias("label"))


@query(f"""SELECT transcript_id, tape_no, caption_idx, concat('[', caption_idx, '][', format('{{:.2f}}', "start"), 's] ', {_FLAT}) AS line FROM ({C})""")
def caption_prompt_lines(spark, d):
    return both(spark, d, CAPTIONS).select(*TAPE, "caption_idx", tx.caption_line(F.col("caption_idx"), F.col("start"), F.col("text")).alias("line"))


@query(f"""SELECT s.transcript_id, s.segment_idx, concat({"'" + prompts._TITLE.replace("'", "''") + "INTERVIEWEE'"}, chr(10), 'unknown', chr(10), 'PART', chr(10), s.text, chr(10), 'CONCEPTS', chr(10), coalesce(m.l, '')) AS prompt
FROM ({S}) s LEFT JOIN (SELECT transcript_id, segment_idx, string_agg(name, ', ' ORDER BY match_id) AS l FROM ({M}) GROUP BY ALL) m USING (transcript_id, segment_idx)""")
def title_prompt(spark, d):
    rows = _enriched(spark, d)
    return rows.select("transcript_id", "segment_idx", prompts.title_prompt_column(F.lit(None).cast("string"), F.col("text"), F.transform("matched_concepts", lambda c: c["name"])).alias("prompt"))


@query(f"""SELECT s.transcript_id, s.segment_idx, concat({"'" + prompts._VALIDATE.replace("'", "''") + "'"}, s.text, chr(10), 'CANDIDATES', chr(10), m.l) AS prompt
FROM ({S}) s JOIN (SELECT transcript_id, segment_idx, string_agg('- ' || name, chr(10) ORDER BY match_id) AS l FROM ({M}) GROUP BY ALL) m USING (transcript_id, segment_idx)""")
def validation_prompt(spark, d):
    rows = _enriched(spark, d).where("size(matched_concepts) > 0")
    return rows.select("transcript_id", "segment_idx", prompts.validate_prompt_column(F.col("text"), F.transform("matched_concepts", lambda c: c["name"])).alias("prompt"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"""WITH x AS (SELECT transcript_id, text, row_number() OVER (PARTITION BY transcript_id ORDER BY segment_idx) - 1 AS i FROM ({S}))
SELECT transcript_id, concat({_quoted(prompts._SELECT)}, string_agg(concat('[', i, '] ', {_FLAT}), chr(10) || chr(10) ORDER BY i)) AS prompt FROM x GROUP BY transcript_id""")
def selection_prompt(spark, d):
    rows = both(spark, d, SEGMENTS).groupBy("transcript_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("segment_idx", "text"))), lambda r: r["text"]).alias("t"))
    return rows.select("transcript_id", prompts.select_prompt_column(F.col("t")).alias("prompt"))


@query(f"""SELECT s.transcript_id, s.segment_idx, concat({_quoted(prompts._TOPDOWN)}, m.l, chr(10), 'PART', chr(10), s.text) AS prompt
FROM ({S}) s JOIN (SELECT transcript_id, segment_idx, string_agg('- ' || name, chr(10) ORDER BY match_id) AS l FROM ({M}) GROUP BY ALL) m USING (transcript_id, segment_idx)""")
def topdown_prompt(spark, d):
    rows = _enriched(spark, d).where("size(matched_concepts) > 0")
    return rows.select("transcript_id", "segment_idx", prompts.topdown_prompt_column(F.transform("matched_concepts", lambda c: c["name"]), F.col("text")).alias("prompt"))


def _window_prompt_sql(head: str, seconds: int) -> str:
    return f"""WITH c AS ({C}), f AS (SELECT *, first_value("end") OVER w AS fe FROM c WINDOW w AS (PARTITION BY transcript_id, tape_no ORDER BY caption_idx)),
v AS (SELECT *, max(CASE WHEN "end" > fe + {seconds} THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id, tape_no ORDER BY caption_idx) AS bad FROM f)
SELECT transcript_id, tape_no, concat({_quoted(head)}, string_agg(concat('[', caption_idx, '][', format('{{:.2f}}', "start"), 's] ', {_FLAT}), chr(10) ORDER BY caption_idx)) AS prompt
FROM v WHERE bad = 0 GROUP BY transcript_id, tape_no"""


def _window_prompt(spark, d, task: str, minutes: int):
    first = sg.caption_time_prefix(both(spark, d, CAPTIONS), TAPE, minutes)
    line = tx.caption_line(F.col("caption_idx"), F.col("start"), F.col("text"))
    lines = first.groupBy(*TAPE).agg(F.transform(F.array_sort(F.collect_list(F.struct("caption_idx", line.alias("l")))), lambda r: r["l"]).alias("l"))
    return lines.select(*TAPE, prompts.lines_prompt_column(F.col("l"), task).alias("prompt"))


@query(_window_prompt_sql(prompts._SEGMENT, 1200))
def segment_prompt(spark, d):
    """The prompt of each tape's first window of 20 minutes."""
    return _window_prompt(spark, d, "segment", 20)


@query(_window_prompt_sql(prompts._NAME, 300))
def name_prompt(spark, d):
    return _window_prompt(spark, d, "name", 5)


# --- segments ------------------------------------------------------------------------------------


@query(f"""WITH c AS ({C}), f AS (SELECT *, first_value("end") OVER w AS fe FROM c WINDOW w AS (PARTITION BY transcript_id, tape_no ORDER BY caption_idx)),
v AS (SELECT *, max(CASE WHEN "end" > fe + 300 THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id, tape_no ORDER BY caption_idx) AS bad FROM f)
SELECT transcript_id, tape_no, caption_idx FROM v WHERE bad = 0""")
def caption_time_prefix(spark, d):
    return sg.caption_time_prefix(both(spark, d, CAPTIONS), TAPE, 5).select(*TAPE, "caption_idx")


@query(f"""WITH c AS (SELECT x.*, CASE WHEN b.caption_idx IS NULL THEN 0 ELSE 1 END AS mark FROM ({C}) x LEFT JOIN ({B}) b USING (transcript_id, tape_no, caption_idx)),
n AS (SELECT *, CAST(sum(mark) OVER (PARTITION BY transcript_id, tape_no ORDER BY caption_idx) - 1 AS INTEGER) AS segment_idx FROM c)
SELECT transcript_id, tape_no, segment_idx, arg_min("start", caption_idx) AS start_s, arg_max("end", caption_idx) AS end_s,
string_agg({_FLAT}, ' ' ORDER BY caption_idx) AS text, CAST(count(*) AS INTEGER) AS n_captions FROM n WHERE segment_idx >= 0 GROUP BY ALL""")
def segments_from_boundaries(spark, d):
    got = sg.segments_from_boundaries(both(spark, d, CAPTIONS), both(spark, d, BOUNDARIES), TAPE)
    return got.withColumnsRenamed({"start": "start_s", "end": "end_s"})


def _lists(spark, d):
    b = both(spark, d, BOUNDARIES)
    return b.select(*TAPE, F.col("caption_idx").alias("segment_idx"),
                    F.array(F.col("caption_idx") + 2, F.col("caption_idx"), F.col("caption_idx"), F.lit(-1), F.col("caption_idx") + 1).alias("caption_indices"))


@query(f"""WITH l AS (SELECT transcript_id, tape_no, caption_idx AS segment_idx, unnest([0, 1, 2, 4]) AS pos, unnest([caption_idx + 2, caption_idx, caption_idx, caption_idx + 1]) AS i FROM ({B})),
j AS (SELECT l.transcript_id, l.tape_no, l.segment_idx, l.pos, c."start", c."end", c.text FROM l JOIN ({C}) c ON l.transcript_id = c.transcript_id AND l.tape_no = c.tape_no AND l.i = c.caption_idx)
SELECT transcript_id, tape_no, segment_idx, arg_min("start", pos) AS start_s, arg_max("end", pos) AS end_s, string_agg({_FLAT}, ' ' ORDER BY pos) AS text,
CAST(count(*) AS INTEGER) AS n_captions FROM j GROUP BY ALL""")
def segments_from_indices(spark, d):
    return sg.segments_from_indices(both(spark, d, CAPTIONS), _lists(spark, d), TAPE).withColumnsRenamed({"start": "start_s", "end": "end_s"})


_COSTED = """SELECT coalesce(source, '-') AS source, doc_id, CAST(floor(coalesce(length(text), 0) / CAST(4 AS DOUBLE)) AS BIGINT) + 10 AS cost FROM {documents}"""


@query(f"""WITH RECURSIVE d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM ({duck(_COSTED)})),
f AS (SELECT source, doc_id, r, cost, 0 AS batch_id, 0 AS pos, cost AS used FROM d WHERE r = 1
UNION ALL SELECT d.source, d.doc_id, d.r, d.cost, CASE WHEN f.used + d.cost > 2000 THEN f.batch_id + 1 ELSE f.batch_id END,
CASE WHEN f.used + d.cost > 2000 THEN 0 ELSE f.pos + 1 END, CASE WHEN f.used + d.cost > 2000 THEN d.cost ELSE f.used + d.cost END FROM f JOIN d ON d.source = f.source AND d.r = f.r + 1)
SELECT source, doc_id, CAST(batch_id AS INTEGER) AS batch_id, CAST(pos AS INTEGER) AS pos_in_batch FROM f""")
def token_batches(spark, d):
    return batching.token_batches(both(spark, d, _COSTED), ["source"], "doc_id", "cost", 2000).drop("cost")


@query(f"""WITH RECURSIVE x AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY segment_idx) AS r, length(text) // 4 + 10 AS cost FROM ({S})),
f AS (SELECT transcript_id, segment_idx, r, 0 AS b, 0 AS pos, cost AS used FROM x WHERE r = 1
UNION ALL SELECT x.transcript_id, x.segment_idx, x.r, CASE WHEN f.used + x.cost > 300 THEN f.b + 1 ELSE f.b END, CASE WHEN f.used + x.cost > 300 THEN 0 ELSE f.pos + 1 END,
CASE WHEN f.used + x.cost > 300 THEN x.cost ELSE f.used + x.cost END FROM f JOIN x ON x.transcript_id = f.transcript_id AND x.r = f.r + 1),
p AS (SELECT transcript_id, b, unnest([0, 1, 2]) AS sel_pos, unnest([1, 0, 99]) AS pos FROM (SELECT DISTINCT transcript_id, b FROM f))
SELECT transcript_id, CAST(row_number() OVER (PARTITION BY transcript_id ORDER BY b, sel_pos) - 1 AS INTEGER) AS selection_idx, segment_idx FROM p JOIN f USING (transcript_id, b, pos)""")
def segment_selection(spark, d):
    rows = both(spark, d, SEGMENTS).withColumn("cost", F.floor(F.length("text") / 4) + 10)
    batched = batching.token_batches(rows, ["transcript_id"], "segment_idx", "cost", 300)
    answers = batched.select("transcript_id", "batch_id").distinct().select("*", F.lit(100).alias("n"), F.lit('```json\n{"relevant_segments": [1, 0, 99]}\n```').alias("raw"))
    return sg.select_segments(batched, seg.picked(answers, ["transcript_id", "batch_id"]), ["transcript_id"]).select("transcript_id", "selection_idx", "segment_idx")


# --- thesaurus -------------------------------------------------------------------------------------

_T = duck(TRIPLES)
_PIVOT = f"""SELECT s, bool_or(p = 'excludeFlag' AND lower(trim(o)) = 'false') AS flagged, bool_or(p = 'topConceptOf') AS top,
bool_or(p = 'inScheme' AND o = 'scheme:technical') AS technical, bool_or(p = 'inScheme' AND o = 'scheme:camps') AS camp, bool_or(p = 'inScheme' AND o = 'scheme:locations') AS loc,
min(CASE WHEN p = 'prefLabel' AND lang = 'nl' THEN o END) AS label, min(CASE WHEN p = 'scopeNote' THEN o END) AS note,
string_agg(DISTINCT CASE WHEN p = 'narrower' THEN o END, ',' ORDER BY CASE WHEN p = 'narrower' THEN o END) AS narrower,
string_agg(DISTINCT CASE WHEN p = 'altLabel' THEN o END, ',') AS alts FROM ({_T}) GROUP BY s HAVING bool_or(p = 'type' AND o = 'Concept')"""


@query(f"""SELECT s AS uri, coalesce(label, '') AS name, CASE WHEN camp THEN 'camp' WHEN loc THEN 'location' ELSE 'other' END AS category, coalesce(note, 'None') AS description,
coalesce(narrower, '') AS narrower, alts AS alternate_names FROM ({_PIVOT}) WHERE NOT (flagged AND NOT top) AND NOT technical""")
def concepts_from_triples(spark, d):
    got = th.concepts_from_triples(both(spark, d, TRIPLES), VOCABULARY)
    return got.select("uri", "name", "category", "description", F.array_join("narrower", ",").alias("narrower"), F.array_join("alternate_names", ",").alias("alternate_names"))


@query(f"SELECT count(*) FILTER (WHERE NOT (flagged AND NOT top) AND NOT technical) AS n_loaded, count(*) FILTER (WHERE (flagged AND NOT top) OR technical) AS n_skipped FROM ({_PIVOT})")
def thesaurus_stats(spark, d):
    return th.load_stats(both(spark, d, TRIPLES), VOCABULARY)


@query("""SELECT 'descriptive' AS kind, concept_idx FROM concepts WHERE category = 'other' AND coalesce(description, '') <> ''
UNION SELECT 'top', concept_idx FROM concepts WHERE category = 'other' AND len(top_concept) > 0
UNION SELECT 'place', concept_idx FROM concepts WHERE category IN ('camp', 'location')""")
def concept_partitions(spark, d):
    sets = th.concept_sets(table(spark, d, "concepts"))
    parts = [df.select(F.lit(k).alias("kind"), "concept_idx") for k, df in sets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query("""SELECT DISTINCT concept_idx FROM concepts WHERE category = 'other' AND coalesce(description, '') <> ''
AND uri IN (SELECT unnest(narrower) FROM concepts WHERE category = 'other' AND len(top_concept) > 0)
AND concept_idx NOT IN (SELECT concept_idx FROM concepts WHERE len(top_concept) > 0)""")
def narrower_step(spark, d):
    sets = th.concept_sets(table(spark, d, "concepts"))
    seen = table(spark, d, "concepts").where("size(top_concept) > 0").select("uri")
    return th.narrower_step(sets["top"], sets["descriptive"], seen).select("concept_idx").distinct()


# --- matching --------------------------------------------------------------------------------------


@query(rf"""SELECT s.transcript_id, s.segment_idx, r.concept_idx FROM ({S}) s JOIN ref_concepts r ON contains(lower(s.text), lower(r.name))
WHERE r.category IN ('camp', 'location') AND regexp_matches(lower(s.text), '(^|[^\p{{L}}\p{{N}}_])' || lower(r.name) || '($|[^\p{{L}}\p{{N}}_])')""")
def exact_occurrence(spark, d):
    places = th.concept_sets(table(spark, d, "ref_concepts").withColumn("top_concept", F.array().cast("array<string>")))["place"]
    return m.exact_occurrence(both(spark, d, SEGMENTS), places, SEG).select(*SEG, "concept_idx")


@query("""WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 20 = 0), c AS (SELECT vec_id AS concept_idx, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT q.vec_id, concept_idx, list_cosine_similarity(q.v, c.v) AS sim FROM q, c),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, concept_idx DESC) AS rk FROM s)
SELECT vec_id, concept_idx, CAST(rk AS INTEGER) AS rank, round(sim, 6) AS score FROM r WHERE rk <= 10""")
def embedding_topk(spark, d):
    """The ten nearest of all rows for every row whose id is divisible by 20."""
    e = table(spark, d, "embeddings")
    got = m.embedding_topk(e.where("vec_id % 20 = 0"), e, 10, query_id="vec_id", concept_id="vec_id")
    return got.select("vec_id", "concept_idx", "rank", F.round("score", 6).alias("score"))


@query("""WITH t AS (SELECT vec_id, list_transform(range(0, 8), lambda i: embedding[i * 8 + 1 : i * 8 + 8]::DOUBLE[]) AS vs FROM embeddings),
k AS (SELECT vec_id, list_filter(vs, lambda v: v[1] > 0) AS vs FROM t),
p AS (SELECT vec_id, list_transform(range(1, 9), lambda j: list_sum(list_transform(vs, lambda v: v[j])) / len(vs)) AS m FROM k WHERE len(vs) > 0)
SELECT vec_id, array_to_string(list_transform(m, lambda x: format('{:.4f}', round(x / sqrt(list_sum(list_transform(m, lambda y: y * y))), 4) + 0.0)), ',') AS pooled FROM p""")
def mean_pool_normalize(spark, d):
    """Eight token vectors of eight numbers per row, masked by the sign of their first number."""
    e = table(spark, d, "embeddings")
    vs = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    pooled = vec.l2_normalize(vec.masked_mean(vs, F.transform(vs, lambda v: (F.get(v, F.lit(0)) > 0).cast("int"))))
    rows = e.select("vec_id", pooled.alias("p")).where("p IS NOT NULL")
    return rows.select("vec_id", F.array_join(F.transform("p", lambda x: F.format_string("%.4f", F.round(x, 4) + 0.0)), ",").alias("pooled"))


@query()
def token_counter(spark, d):
    """Tokens of each segment by a public rank file."""
    return both(spark, d, SEGMENTS).select(*SEG, token_count(F.col("text"), RankCounter()).alias("n_tokens"))


@query("SELECT transcript_id, segment_idx, length(text) // 4 AS n_tokens FROM (" + S + ")")
def character_counter(spark, d):
    return both(spark, d, SEGMENTS).select(*SEG, token_count(F.col("text"), CharacterCounter()).alias("n_tokens"))


@query()
def concept_embeddings(spark, d):
    """Hashed vectors of all concept texts."""
    c = table(spark, d, "ref_concepts")
    return c.select("concept_idx", embed(tx.concept_text(F.col("name"), F.col("alternate_names"), F.col("description")), HashingEmbedder()).alias("embedding"))


@query(rf"""SELECT k, trim(CASE k % 5 WHEN 0 THEN concat('[{{"concept":"', name, '","score":0.8}}]') WHEN 1 THEN concat('[{{"concept":"', name, '","score":"0.6"}}]')
WHEN 2 THEN concat('["', name, '", "', name, '"]') ELSE trim(raw) END) AS cleaned FROM ({duck(RAW)})""")
def clean_llm_json(spark, d):
    return both(spark, d, RAW).select("k", tx.clean_llm_json(F.col("raw")).alias("cleaned"))


_ITEMS_SQL = f"""SELECT k, name AS concept, CASE k % 5 WHEN 0 THEN CAST(0.8 AS DOUBLE) WHEN 1 THEN CAST(0.6 AS DOUBLE) WHEN 3 THEN CAST(0.25 AS DOUBLE) END AS score
FROM ({duck(RAW)}) WHERE k % 5 < 4"""


@query(_ITEMS_SQL)
def llm_response_parse(spark, d):
    return m.parse_answers(both(spark, d, RAW), ["k"]).select("k", "concept", "score")


@query(f"SELECT i.k, r.concept_idx, i.score, 'Top-down matching' AS source FROM ({_ITEMS_SQL}) i JOIN ref_concepts r ON r.name = i.concept")
def llm_response_join(spark, d):
    items = m.parse_answers(both(spark, d, RAW), ["k"])
    return m.answers_to_concepts(items, table(spark, d, "ref_concepts"), ["k"]).select("k", "concept_idx", "score", "source")


@query(f"""SELECT m.transcript_id, m.segment_idx, m.match_id, m.source, coalesce(i.score, m.score) AS score FROM ({M}) m JOIN ({ITEMS}) i
ON m.transcript_id = i.transcript_id AND m.segment_idx = i.segment_idx AND m.name = i.concept""")
def validate_matches(spark, d):
    return m.validate_matches(_matches(spark, d), _items(spark, d), SEG).select(*SEG, "match_id", "source", "score")


@query(f"""SELECT transcript_id, segment_idx, CAST(row_number() OVER (PARTITION BY transcript_id, segment_idx ORDER BY CASE WHEN source LIKE 'Top-down%' THEN 0 ELSE 1 END, match_id) - 1 AS INTEGER) AS match_idx,
uri, source, score FROM ({M}) WHERE source IS NOT NULL""")
def combine_matches(spark, d):
    rows = _matches(spark, d).withColumn("match_idx", F.col("match_id")).where("source IS NOT NULL")
    return m.combine_matches([rows.where("source LIKE 'Top-down%'"), rows.where("source NOT LIKE 'Top-down%'")], SEG)


@query(f"""SELECT transcript_id, segment_idx, uri, match_id FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id, segment_idx, uri ORDER BY match_idx, match_id) AS r FROM ({M})) WHERE r = 1""")
def dedup_matches(spark, d):
    return m.dedup_matches(_matches(spark, d), SEG, ["match_idx", "match_id"]).select(*SEG, "uri", "match_id")


@query(f"SELECT transcript_id, tape_no, speaker_no, CASE WHEN (transcript_id + speaker_no) % 4 < 3 THEN full_name END AS name FROM ({duck(NAME_RAW)})")
def extract_name(spark, d):
    return both(spark, d, NAME_RAW).select(*TAPE, "speaker_no", m.name_of(tx.clean_llm_json(F.col("raw"))).alias("name"))


# --- stages with a backend; the offline backend is a fixed function, so rows repeat ------------------

BACKEND = RuleBackend()


def _files(spark, d):
    """Captions numbered from 0 per tape, as a parsed file has them."""
    return vtt.parse_files(_vtt_files(spark, d)).where("error IS NULL").drop("error")


@query()
def segmentation_loop(spark, d):
    return seg.segment_captions(_files(spark, d), BACKEND, ["file_name"])


@query()
def interviewee_names(spark, d):
    return seg.interviewee_names(_files(spark, d), BACKEND, ["file_name"])


@query(f"""SELECT transcript_id, CAST(row_number() OVER (PARTITION BY transcript_id ORDER BY segment_idx) - 1 AS INTEGER) AS selection_idx, segment_idx
FROM ({S}) WHERE length({_FLAT}) >= 60""")
def segment_choice(spark, d):
    counter = CharacterCounter()
    costed = both(spark, d, SEGMENTS).withColumn("tokens", token_count(tx.flatten(F.col("text")), counter))
    return seg.choose_segments(costed, BACKEND, ["transcript_id"], "tokens", 4000, seg.selection_tokens(counter)).select("transcript_id", "selection_idx", "segment_idx")


def _tree(spark, d):
    """The concepts table with one row per concept."""
    c = table(spark, d, "concepts")
    flat = F.array_distinct(F.flatten(F.collect_list(F.coalesce("narrower", F.array().cast("array<string>")))))
    return c.groupBy("concept_idx").agg(F.min("uri").alias("uri"), F.coalesce(F.min("name"), F.lit("")).alias("name"), F.coalesce(F.min("category"), F.lit("other")).alias("category"),
                                        F.min("description").alias("description"), F.array_sort(flat).alias("narrower"),
                                        F.array_distinct(F.flatten(F.collect_list(F.coalesce("top_concept", F.array().cast("array<string>"))))).alias("top_concept"))


@query()
def match_validation(spark, d):
    """Matches that the backend keeps, asked once per segment with all its candidates."""
    segments = both(spark, d, SEGMENTS)
    candidates = _matches(spark, d).withColumn("match_idx", F.col("match_id")).drop("match_id")
    return pipeline.validated(segments, candidates, table(spark, d, "ref_concepts"), BACKEND, SEG).select(*SEG, "match_idx", "uri", "source", "score")


@query()
def topdown_bfs(spark, d):
    sets = th.concept_sets(_tree(spark, d))
    return match_topdown(both(spark, d, SEGMENTS), sets["descriptive"], sets["top"], BACKEND, SEG, CharacterCounter(), 2000)


@query()
def pipeline_enriched(spark, d):
    """All stages over all tapes: segments by the backend, choice, candidates, validation,
    top-down walk, combination, names and titles."""
    keys, embedder, counter = ["file_name"], HashingEmbedder(), CharacterCounter()
    captions = materialize(_files(spark, d), "captions")
    names = materialize(seg.interviewee_names(captions, BACKEND, keys), "names")
    found = materialize(seg.segment_captions(captions, BACKEND, keys).drop("n_captions").withColumn("tokens", token_count(tx.flatten(F.col("text")), counter)), "segments")
    release(captions)
    chosen = materialize(seg.choose_segments(found, BACKEND, keys, "tokens", 8000, seg.selection_tokens(counter)), "selected").select(*keys, F.col("selection_idx").alias("segment_idx"), "start", "end", "text")
    release(found)
    tree = _tree(spark, d).withColumn("alternate_names", F.lit(None).cast("array<string>"))
    places = table(spark, d, "ref_concepts").where("category <> 'other'").select(
        (F.col("concept_idx") + 10_000_000).alias("concept_idx"), "uri", "name", "category", "description", F.array().cast("array<string>").alias("narrower"),
        F.array().cast("array<string>").alias("top_concept"), "alternate_names")
    concepts = materialize(tree.where("category = 'other'").unionByName(places), "concepts")
    described = th.concept_sets(concepts)["descriptive"]
    vectors = described.select("concept_idx", embed(tx.concept_text(F.col("name"), F.col("alternate_names"), F.col("description")), embedder).alias("embedding"))
    return pipeline.enrich(chosen, names, concepts, materialize(vectors, "vectors"), BACKEND, embedder, counter, [*keys, "segment_idx"], 4000, 10, titles=True)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Captions to boundary segments, linked to places by whole-word occurrence, nested."""
    segments = sg.segments_from_boundaries(both(spark, d, CAPTIONS), both(spark, d, BOUNDARIES), TAPE)
    ref = table(spark, d, "ref_concepts")
    keys = [*TAPE, "segment_idx"]
    found = m.exact_occurrence(segments, ref.where("category IN ('camp', 'location')"), keys).join(ref.select("concept_idx", "uri"), "concept_idx")
    matches = found.select(*keys, F.col("concept_idx").alias("match_idx"), "uri", "source", "score")
    names = table(spark, d, "speakers").where("speaker_no = 2").select(*TAPE, F.col("full_name").alias("name"))
    return sink.enrich_rows(segments.drop("n_captions"), matches, ref, names, TAPE)
