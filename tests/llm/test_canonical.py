import random
import string

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from talespan.llm import canonical as c
from talespan.llm.captiontext import osa

REF = [("u:1", ["Kamp Aspelaplas", "Wimmelingkerke"]), ("u:2", ["Waterdrukwerk"]), ("u:3", ["salvage convoy duty", None]), ("u:4", ["Fjelepmönde", ""]), ("u:5", ["Oberijnveen"]), ("u:6", ["Oberijnveen"])]


def plain_osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8), st.integers(0, 4))
def test_osa(a, b, limit):
    assert osa(a, b, limit) == min(plain_osa(a, b), limit + 1) or (osa(a, b, limit) > limit and plain_osa(a, b) > limit)


def test_automaton_equals_brute_force():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 9))) for _ in range(150)]
    trie = c.Lexicon([(w, [w]) for w in words], frozenset())
    asked = ["".join(rng.choices("abcdz", k=rng.randint(1, 12))) for _ in range(700)]
    for limit in (0, 1, 2):
        want = {(q, w, d) for q in asked for w in words if abs(len(q) - len(w)) <= limit and (d := plain_osa(q, w)) <= limit}
        assert {(asked[q], trie.forms[w], d) for q, w, d in zip(*(x.tolist() for x in trie.search(asked, limit)))} == want


def test_automaton_reads_words_of_any_length_and_script():
    long = "aé漢" * 400
    trie = c.Lexicon([("u", [long]), ("v", ["straße"])], frozenset())
    word = trie.forms[-1] if len(trie.forms[-1]) > 100 else trie.forms[0]
    asked = [word, word[:600] + word[601:], word[:5] + "x" + word[5:-3], "漢漢漢漢漢漢", "y" * 5000]
    got = {(q, int(d)) for q, _, d in zip(*trie.search(asked, 2))}
    assert got == {(0, 0), (1, 1)}


def answers(spark, values, ref, **more):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")
    ref = spark.createDataFrame(ref, "uri string, name string, alternate_names array<string>")
    return sorted((values[r.id], r.value, r.uri, r.distance) for r in c.map_values(df, ["id"], "text", ref, **more).collect())


def test_block_size_changes_nothing(spark):
    ref = [("U1", "Oostwest", None), ("U2", "Oostkampwest", ["Oud Kampwest"]), ("U3", "Blok 10", None), ("U4", "Blok 11", ["Blok elf"]), ("U5", "Oostwest", None), ("U6", None, [None, "Zuidmond"])]
    values = ["Oost kamp West", "oostwset", "Blok 11", "Blok", "blok 12", "zuidmont; oost kamp west; kamp", "1943", "niets daarvan"]
    want = answers(spark, values, ref)
    for block in (1, 2, 5):
        assert answers(spark, values, ref, block=block) == want
    assert ("Blok 11", "Blok 11", "U4", 0) in want and {x[2] for x in want if x[0] == "Blok"} == {"U3", "U4"} and ("blok 12", "blok 12", "unmatched", -1) in want
    assert ("1943", "1943", "no name", -2) in want and {x[2] for x in want if x[0] == "Oost kamp West"} == {"U1", "U5"}


def test_general_words_are_a_parameter(spark):
    got = answers(spark, ["heilige Brekkum"], [("U1", "Brekkum", None)], general=c.GENERAL | {"heilige"})
    assert got == [("heilige Brekkum", "heilige Brekkum", "U1", 0)]


VALUES = [
    ("Kamp Aspelaplas", ["u:1"]), ("aspelaplas", ["u:1"]), ("K.Z. ASPELA-PLAS!", ["u:1"]), ("Asp elaplsa", ["u:1"]), ("wimmelngkerk", ["u:1"]), ("TW: Waterdrukwerk (?)", ["u:2"]),
    ("plaats/onderwerp: dorp fjelepmonde (gem.)", ["u:4"]), ("Keyword – salvage  convoy duty", ["u:3"]), ("Wolpumgrün", ["unmatched"]), ("waterdrukwerk; Fjelepmönde | nabij Xyzabcdef, 1943", ["no name", "u:2", "u:4", "unmatched"]),
    ("Aspelaplas, kamp\nWaterdrukwerk", ["no name", "u:1", "u:2"]), ("oberijnveen", ["u:5", "u:6"]), ("aspxxxaplas", ["unmatched"]), ("", []), (None, []), ("  ", []), ("kamp", ["no name"]), ("1943", ["no name"]), ("?!", [])]


@pytest.mark.parametrize("block", [c.MOST_ENTRIES, 3])
def test_values(spark, block):
    df = spark.createDataFrame([(i, t, "clash", 5) for i, (t, _) in enumerate(VALUES)], "id int, text string, value string, distance int")
    ref = spark.createDataFrame([(u, n[0], n[1:]) for u, n in REF], "uri string, name string, alternate_names array<string>").withColumn("id", F.lit(3))
    got = c.map_values(df, ["id"], "text", ref, block).collect()
    for i, (text, want) in enumerate(VALUES):
        assert (text, sorted({r.uri for r in got if r.id == i})) == (text, want)


def test_long_text_repeats_and_empty_reference(spark):
    many = "; ".join(["Waterdrukwerk", "Onbekendoord"] * 3000)
    df = spark.createDataFrame([(1, many), (1, many)], "id int, text string")
    ref = spark.createDataFrame([("u:2", "Waterdrukwerk", None)], "uri string, name string, alternate_names array<string>")
    assert sorted(r.uri for r in c.map_values(df, ["id"], "text", ref).select("uri").distinct().collect()) == ["u:2", "unmatched"]
    assert {r.uri for r in c.map_values(df, ["id"], "text", ref.limit(0)).select("uri").distinct().collect()} == {"unmatched"}
    assert c.map_values(df.limit(0), ["id"], "text", ref).count() == 0 and string
