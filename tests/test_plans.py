"""Plans that the operators must keep: pruned reads, no nested loops, no windows over whole keys."""

import pytest
from conftest import SMALL

from talespan.__main__ import elapsed_text, read_env
from talespan.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_occurrence_is_an_equi_join(spark):
    p = plan(registry.QUERIES["exact_occurrence"](spark, SMALL))
    assert "HashJoin" in p or "SortMergeJoin" in p
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_reads_are_pruned_and_filters_pushed(spark):
    p = plan(registry.QUERIES["exact_occurrence"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(text)" in p and "loaded_at" not in p and "seg_type" not in p


def test_texts_are_no_part_of_the_exploded_grams(spark):
    import re

    p = plan(registry.QUERIES["exact_occurrence"](spark, SMALL))
    assert (grams := re.findall(r"Generate explode\(array_distinct.*", p)) and not [x for x in grams if "_text" in x.partition("false")[0].rpartition("),")[2]]


def test_similarity_search_brings_no_vectors_to_the_driver(spark):
    p = plan(registry.QUERIES["embedding_topk"](spark, SMALL))
    assert "FlatMapCoGroupsInArrow" in p and "Broadcast" not in p and "Cartesian" not in p


@pytest.mark.parametrize("name", ["caption_time_prefix", "dedup_matches", "concepts_from_triples"])
def test_no_window(spark, name):
    assert "Window" not in plan(registry.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["concept_label", "concept_text", "clean_llm_json", "incremental_antijoin", "serialize_segments", "mean_pool_normalize", "ntriples_scan"])
def test_stays_in_the_jvm(spark, name):
    assert "Python" not in plan(registry.QUERIES[name](spark, SMALL)) and "InPandas" not in plan(registry.QUERIES[name](spark, SMALL))


def test_env_and_elapsed(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# x\nMODEL='rules'\nDATA_FOLDER = in\nbroken\n")
    monkeypatch.setenv("DATA_FOLDER", "other")
    env = read_env(str(tmp_path / ".env"))
    assert env["MODEL"] == "rules" and env["DATA_FOLDER"] == "other"
    assert elapsed_text(3.14159) == "3.14 seconds" and elapsed_text(125) == "2 min 5 sec"


def test_no_shuffle_of_all_grams(spark, monkeypatch):
    from pyspark.sql import functions as F
    from talespan.operators import matching as m

    s = spark.createDataFrame([(1, "Kamp Vught en Westerbork"), (2, "niets")], "s int, text string")
    places = spark.createDataFrame([(0, "kamp vught"), (1, "westerbork"), (2, "kamp")], "concept_idx int, name string").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = m.exact_occurrence(s, places, ["s"])
        assert "BroadcastHashJoin" in plan(got)
        monkeypatch.setattr(m, "SENT_NAMES", 2)
        want = m.exact_occurrence(s, places, ["s"])
        assert "BroadcastHashJoin" not in plan(want) and sorted(got.collect()) == sorted(want.collect()) and want.agg(F.count("*")).first()[0] == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
