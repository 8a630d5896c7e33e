import json
import os

import pytest
from pyspark.sql import functions as F

from talespan.backends.embed import HashingEmbedder
from talespan.config import ConfigError, EngineConfig
from talespan.functions.text import repair_text
from talespan.sinks.documents import export_documents
from talespan.sources import cache, incremental, ntriples
from talespan.sources.vtt import parse_files, parse_vtt, read_vtt


@pytest.mark.parametrize("content, want", [
    ("WEBVTT\n\n00:00:01.000 --> 00:00:02.500\nHallo\n", [(1.0, 2.5, "Hallo")]),
    ("WEBVTT\r\n\r\n00:01.000 --> 00:02.000\r\nA\r\nB\r\n\r\n", [(1.0, 2.0, "A\nB")]),
    ("WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\nX\n\n2\n00:00:03.000 --> 00:00:04.000\nY", [(1.0, 2.0, "1\nX"), (3.0, 4.0, "2\nY")]),
    ("WEBVTT\n\nNOTE hier\n\n00:00:01.000 --> 00:00:02.000\nX", [(1.0, 2.0, "NOTE hier\nX")]),
    ("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n\n00:00:03.000 --> 00:00:04.000\nY", [(3.0, 4.0, "Y")]),
    ("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n\nX\n\n", [(1.0, 2.0, "X")]),
    ("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n00:00:05.000 --> 00:00:06.000\nX", [(5.0, 6.0, "X")]),
    ("WEBVTT\n\n05.5 --> 00:00:05\nX", [(5.005, 0.005, "X")]),
    ("WEBVTT", []),
])
def test_vtt_goldens(content, want):
    assert list(parse_vtt(content)) == want


@pytest.mark.parametrize("content", ["﻿WEBVTT\n", "WEBVTT titel\n", "", "WEBVTT\n\n00:01.000 --> 00:02.000 align:start\nX", "WEBVTT\n\n1:00:00:01.000 --> 00:02.000\nX"])
def test_vtt_errors_become_rows(spark, content):
    row = parse_files(spark.createDataFrame([("f.vtt", content)], "file_name string, value string")).collect()
    assert len(row) == 1 and row[0].error and row[0].text is None


def test_read_vtt_takes_only_vtt_files(spark, tmp_path):
    (tmp_path / "a.vtt").write_text("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nHé\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("x")
    rows = read_vtt(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.caption_idx, r.text) for r in rows] == [("a.vtt", 0, "Hé")]


def test_ntriples(spark):
    lines = ['<a> <p> <b> .', '<a> <p> "x \\"y\\" \\u00e9"@NL .', '# comment', '', '_:n <p> "1"^^<t> . # end', 'broken', '<a> <p> <b> .']
    rows = ntriples.parse_triples(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert {(r.s, r.o, r.o_kind, r.lang, r.datatype) for r in rows} == {("a", "b", "iri", None, None), ("a", 'x "y" é', "literal", "nl", None), ("_:n", "1", "literal", None, "t")}


def test_repair_text():
    assert repair_text("geÃ¯nterviewde &gt; x\r\ny“z”\x07") == 'geïnterviewde > x\ny"z"'
    assert repair_text("<b>&amp;</b>") == "<b>&amp;</b>"


def test_incremental(spark, tmp_path):
    files = spark.createDataFrame([("a.vtt",), ("b.vtt",), ("c.txt",), ("d.x.vtt",)], "file_name string")
    done = spark.createDataFrame([("a_enriched_segments.json",), ("d.x_enriched_segments.json",)], "file_name string")
    assert [r.file_name for r in incremental.new_inputs(files, done).collect()] == ["b.vtt"]
    assert incremental.list_files(spark, str(tmp_path / "none")).count() == 0


def test_embedding_cache_follows_texts(spark, tmp_path):
    e, d = HashingEmbedder(8), str(tmp_path)
    one = {r.k: r.embedding for r in cache.embed_cached(spark.createDataFrame([(1, "a b"), (2, None)], "k int, t string"), "k", "t", e, d).collect()}
    two = {r.k: r.embedding for r in cache.embed_cached(spark.createDataFrame([(1, "c"), (3, "a b")], "k int, t string"), "k", "t", e, d).collect()}
    assert one[1] == two[3] and one[1] != two[1] and set(one[2]) == {0.0}


def test_cached_table(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3).select(F.col("id"))
    p = str(tmp_path / "t")
    assert cache.cached(spark, p, make).count() == 3 and cache.cached(spark, p, make).count() == 3 and len(made) == 1
    cache.cached(spark, p, make, force_reload=True)
    assert len(made) == 2
    assert cache.fingerprint(spark.range(5)) == cache.fingerprint(spark.range(5).orderBy(F.col("id").desc())) != cache.fingerprint(spark.range(6))


def test_export_pretty_json(spark, tmp_path):
    docs = spark.createDataFrame([("x.json", '[{"a":"é","b":null}]')], "n string, j string")
    assert export_documents(docs, str(tmp_path / "o"), "n", "j") == 1
    text = (tmp_path / "o" / "x.json").read_text(encoding="utf-8")
    assert json.loads(text) == [{"a": "é", "b": None}] and "é" in text and text.startswith("[\n  {") and os.listdir(tmp_path / "o") == ["x.json"]


def test_config():
    c = EngineConfig.from_env({"MODEL": "rules", "DATA_FOLDER": "d", "TOKEN_LIMIT": "5", "FORCE_RELOAD": "False"})
    assert (c.max_tokens, c.minutes_per_batch, c.force_reload) == (5, 20, False)
    for bad in ({"DATA_FOLDER": "d"}, {"MODEL": "m"}, {"MODEL": "m", "DATA_FOLDER": "d", "TOKEN_LIMIT": "x"}, {"MODEL": "m", "DATA_FOLDER": "d", "MINUTES_PER_BATCH": "-1"}):
        with pytest.raises(ConfigError):
            EngineConfig.from_env(bad)
