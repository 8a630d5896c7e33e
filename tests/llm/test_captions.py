import random

import pytest
from pyspark.sql import functions as F

from talespan.llm import captionchunks as ch, runs, turns
from talespan.llm.captiontext import Labels, WordTable, pieces

WHO = Labels([(1, "Cornelis van der Ekkselema"), (2, "Antje de Gronnulaard"), (3, "Bram Ekkehof")])
CAP = "transcript_id long, tape_no int, caption_idx int, role string, text string, start_ms long, end_ms long"
SPK = "transcript_id long, tape_no int, speaker_no int, full_name string"


@pytest.mark.parametrize("label, no", [
    ("INT", 1), ("Interviewer", 1), ("Interviever", 1), ("interviewee", 2), ("Geïnterviewde", 2), ("Geintervieuwde", 2), ("narator", 2), ("Q", 1), ("S1", 1), ("SPEAKER_02", 2), ("spreker 3", 3),
    ("dhr. Ekkselema", 1), ("Mw. Gronnulaard", 2), ("ANTJE DE GRONNULAARD", 2), ("CVDE", 1), ("Gronnullaard", 2), ("Ze zeiden", None), ("altijd", None), ("", None), ("x" * 500, None)])
def test_labels(label, no):
    assert WHO.get(label) == no


@pytest.mark.parametrize("text, want", [
    ("INT: Hoe oud was u?", [(None, ""), (1, "Hoe oud was u?")]), ("Ja, ehm... ja.", [(None, "Ja, ja.")]), ("[00:01:02] <i>Toen</i> (lacht) kwam **zucht** hij", [(None, "Toen kwam hij")]),
    ("klaar.\n>> Spreker 1: Wie?", [(None, "klaar."), (1, "Wie?")]), ("- S1: Waar?\n- <v Narrator> Daar.", [(None, ""), (1, "Waar?"), (2, "Daar.")]), ("&gt;&gt; INT: Wie?", [(None, ""), (1, "Wie?")]),
    ("Ze zeiden: kom", [(None, "Ze zeiden: kom")]), ("[NARR]: Ja", [(None, ""), (2, "Ja")]), ("0:02:30 SPEAKER_02: Het", [(None, ""), (2, "Het")]), ("toen. 00:00:52,270 Spreker 2: Wij", [(None, "toen."), (2, "Wij")]),
    ("♪ ♪", [(None, "")]), ("...", [(None, "")]), (None, [(None, "")]), ("", [(None, "")]), ("[klok slaat, 3 keer] {coughs}", [(None, "")]), ("Hoe\nwas\xa0dat", [(None, "Hoe was dat")])])
def test_pieces(text, want):
    got = [(s, " ".join(w)) for s, w in pieces(text, WHO, WordTable())]
    assert got == [(s, w) for s, w in want]


def frames(spark, rows, who=((1, 1, 1, "Ann Bakker"), (1, 1, 2, "Bo Smid"))):
    return spark.createDataFrame(rows, CAP).withColumn("chunk", F.lit("clash")).withColumn("who", F.lit(1)), spark.createDataFrame(list(who), SPK)


def random_captions(seed, n=400):
    rng = random.Random(seed)
    rows, idx = [], 0
    for _ in range(n):
        idx += rng.choice([1, 1, 1, 3])
        base = rng.choice(["wij woonden destijds in Haarlem", "de bakkerij was gesloten", "er stonden 9 wagens", "...", None, "er stonden 7 wagens"])
        if base and rng.random() < 0.3:
            base = base.replace("woonden", rng.choice(["wonden", "woodnen"])).upper()
        label = rng.choice(["", "", "", "", "INT: ", "A: ", "Bakker: ", "[S2] "])
        rows.append((1, 1, idx, rng.choice([None, None, None, "narrator", "INT"]), None if base is None else label + base, idx * 1000, rng.choice([idx * 1000 + 500, None])))
    return rows


def brute_turns(rows):
    labels, words, state, out = Labels([(1, "Ann Bakker"), (2, "Bo Smid")]), WordTable(), 0, []
    for r in sorted({x[2]: x for x in rows}.values(), key=lambda x: x[2]):
        got = pieces(r[4], labels, words)
        if r[3] and labels.get(r[3]):
            state = labels.get(r[3])
        for s, w in got:
            state = s or state
            if w:
                if out and out[-1][0] == state:
                    out[-1][2], out[-1][3] = r[2], out[-1][3] + len(w)
                else:
                    out.append([state, r[2], r[2], len(w)])
    return [(i + 1, *o) for i, o in enumerate(out)]


@pytest.mark.parametrize("chunk", [5, 64, 4096])
def test_turns_equal_one_pass(spark, chunk):
    rows = random_captions(1)
    cap, spk = frames(spark, rows + rows[:50])
    got = sorted((r.turn_no, r.speaker_no, r.first_idx, r.last_idx, r.n_words) for r in turns.speaker_turns(cap, spk, chunk=chunk).collect())
    assert got == brute_turns(rows)


def brute_runs(rows):
    labels, words, state, seq = Labels([(1, "Ann Bakker"), (2, "Bo Smid")]), WordTable(), 0, []
    for r in sorted({x[2]: x for x in rows}.values(), key=lambda x: x[2]):
        got = pieces(r[4], labels, words)
        if r[3] and labels.get(r[3]):
            state = labels.get(r[3])
        own, who = [], set()
        for s, w in got:
            state = s or state
            if w:
                who.add(state)
                own += [words.get(x) for x in w]
        seq.append((r, own, who))
    out, i = [], 0
    while i < len(seq):
        j = i
        while j + 1 < len(seq) and len(seq[j][2]) == 1 and seq[j + 1][2] == seq[j][2] and runs.same_words(seq[j][1], seq[j + 1][1]):
            j += 1
        if j > i:
            a, b = seq[i][0], seq[j][0]
            out.append((a[2], b[2], j - i + 1, None if b[6] is None else b[6] - a[5]))
        i = j + 1
    return out


@pytest.mark.parametrize("chunk", [4, 50, 4096])
def test_runs_equal_one_pass(spark, chunk):
    rows = [r for r in random_captions(2, 150) for _ in (0,)]
    rows = [(1, 1, i, *r[3:]) for i, r in enumerate(x for r in rows for x in [r] * random.Random(r[2]).choice([1, 1, 2, 5]))]
    cap, spk = frames(spark, rows + rows[:60])
    got = sorted((r.first_idx, r.last_idx, r.n_captions, r.duration_ms) for r in runs.caption_runs(cap, spk, chunk=chunk).collect())
    assert got == brute_runs(rows) and got


@pytest.mark.parametrize("a, b, same", [
    ("dit verhaal", "dit verhhaal", True), ("kelder open", "zolder open", False), ("9 wagens", "7 wagens", False), ("wij gaan", "wij gaan ook", False), ("in 1944 daar", "in 1946 daar", False),
    ("stnoden daar", "stonden daar", True), ("de kar", "de pan", False), ("", "", False), ("kamp op", "kamp om", False)])
def test_same_words(a, b, same):
    assert runs.same_words(a.split(), b.split()) is same


def test_speakers_joined_per_chunk_equal_broadcast(spark):
    cap, spk = frames(spark, random_captions(3, 60))
    one = ch.caption_chunks(cap, spk, 8).select("caption_idx", F.col("who")).collect()
    two = ch.caption_chunks(cap, spk, 8, broadcast_rows=0).select("caption_idx", F.col("who")).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_empty_tables_and_long_text(spark):
    cap, spk = frames(spark, [(1, 1, 0, None, "woord " * 50_000, 0, 1)])
    assert [(r.n_words, r.speaker_no) for r in turns.speaker_turns(cap, spk).collect()] == [(50_000, 0)]
    assert turns.speaker_turns(cap.limit(0), spk).count() == 0 and runs.caption_runs(cap.limit(0), spk).count() == 0
    assert turns.speaker_turns(cap, spk.limit(0)).count() == 1


def test_turn_text_drops_rolling_repeats_and_splits_at_pauses(spark):
    rows = [(1, 1, 0, "INT", "wij gingen naar de stad", 0, 1000), (1, 1, 1, None, "naar de stad en later terug", 1000, 2000), (1, 1, 2, None, "en dan", 60_000, 61_000)]
    cap, spk = frames(spark, rows)
    whole = turns.speaker_turns(cap, spk, with_text=True).collect()
    assert [(r.text, r.n_words, r.start_ms, r.end_ms) for r in whole] == [("wij gingen naar de stad en later terug en dan", 13, 0, 61_000)]
    for chunk in (1, 4096):
        split = sorted((r.turn_no, r.first_idx, r.last_idx) for r in turns.speaker_turns(cap, spk, with_text=True, pause_ms=5000, chunk=chunk).collect())
        assert split == [(1, 0, 1), (2, 2, 2)]


def rolling_captions(seed, n=300):
    """Captions that repeat from one to many of the words before them, some shorter than what is repeated next."""
    rng, said, rows = random.Random(seed), [], []
    for idx in range(n):
        again = said[len(said) - rng.choice([0, 0, 1, 2, 3, 4, 6, 9]):] if said else []
        own = again + [rng.choice(["wij", "gingen", "naar", "de", "stad", "toen"]) for _ in range(rng.choice([0, 1, 2, 2, 5]))]
        said = (said + own[len(again):])[-30:]
        label = rng.choice([""] * 8 + ["INT: ", "A: "])
        rows.append((1, 1, idx, None, label + " ".join(own), idx * 1000, idx * 1000 + 900))
    return rows


def brute_texts(rows):
    labels, words, state, out = Labels([(1, "Ann Bakker"), (2, "Bo Smid")]), WordTable(), 0, []
    for r in rows:
        for s, w in pieces(r[4], labels, words):
            state = state if s is None else s
            if w:
                if not out or out[-1][0] != state:
                    out.append((state, []))
                got = out[-1][1]
                k = turns.overlap([words.get(x) for x in got], [words.get(x) for x in w])
                got.extend(w[k:])
    return [(s, " ".join(w)) for s, w in out]


@pytest.mark.parametrize("chunk", [1, 2, 7, 4096])
def test_turn_texts_equal_one_pass(spark, chunk):
    rows = rolling_captions(4)
    cap, spk = frames(spark, rows)
    got = turns.speaker_turns(cap, spk, with_text=True, chunk=chunk).orderBy("turn_no").collect()
    assert [(r.speaker_no, r.text) for r in got] == brute_texts(rows)


def test_overlap_equals_comparing_every_length():
    rng = random.Random(8)
    for _ in range(3000):
        tail, head = ([rng.choice("ab" if rng.random() < 0.7 else "abc") for _ in range(rng.randrange(n))] for n in (12, 9))
        fits = [k for k in range(1, min(len(tail), len(head)) + 1) if tail[-k:] == head[:k] and (k >= 3 or k == len(head) and k > 1)]
        assert turns.overlap(tail, head) == max(fits, default=0)


def test_a_long_caption_delivered_again_is_dropped(spark):
    said = " ".join(f"woord{i}" for i in range(100))
    rows = [(1, 1, 0, "INT", "toen " + said, 0, 1), (1, 1, 1, None, said, 1, 2), (1, 1, 2, None, said + " klaar", 2, 3)]
    cap, spk = frames(spark, rows)
    for chunk in (1, 4096):
        assert [r.text for r in turns.speaker_turns(cap, spk, with_text=True, chunk=chunk).collect()] == [f"toen {said} klaar"]
    long = ["ja"] * 100_000
    assert turns.overlap(long, long[1:] + ["nee"]) == 99_999 and turns.overlap(long, long) == 100_000


def test_turn_text_with_a_repeat_that_starts_before_the_chunk(spark):
    rows = [(1, 1, 3, "INT", "een twee drie vier", 0, 1), (1, 1, 4, None, "vijf", 1, 2), (1, 1, 5, None, "drie vier vijf zes", 2, 3), (1, 1, 6, None, "vijf zes zeven", 3, 4)]
    cap, spk = frames(spark, rows)
    for chunk in (1, 4, 5, 4096):
        assert [r.text for r in turns.speaker_turns(cap, spk, with_text=True, chunk=chunk).collect()] == ["een twee drie vier vijf zes vijf zes zeven"]


def paused_captions(seed, n=400):
    """Captions with pauses, many without words, times null, swapped or far ahead."""
    rng, at, rows = random.Random(seed), 0, []
    for idx in range(n):
        at += rng.choice([0, 0, 0, 50, 100, 700])
        start, end = at, at + 100
        at = end
        if rng.random() < 0.05:
            start, end = end, start
        if rng.random() < 0.02:
            end += 5000
        text = rng.choice(["wij gingen", "naar huis", "naar de stad", "(coughs)", "[gelach]", "", None, "...", "INT: ja", "A: nee", "INT:"])
        rows.append((1, 1 + (idx > 330), idx, rng.choice([None, None, None, "narrator"]), text, rng.choice([start, start, None]), rng.choice([end, end, None])))
    return rows


def brute_paused_texts(rows, pause):
    """Texts of the turns of brute_paused."""
    labels, words = Labels([(1, "Ann Bakker"), (2, "Bo Smid")]), WordTable()
    starts = {(t[0], t[3]): t for t in brute_paused(rows, pause)}
    out = []
    for tape, no, speaker, first, last, _ in brute_paused(rows, pause):
        said, state = [], 0
        for r in (r for r in rows if r[1] == tape and r[2] <= last):
            if r[3] and labels.get(r[3]):
                state = labels.get(r[3])
            for s, w in pieces(r[4], labels, words):
                state = state if s is None else s
                if w and r[2] >= first and state == speaker:
                    k = turns.overlap([words.get(x) for x in said], [words.get(x) for x in w])
                    said.extend(w[k:])
        out.append((tape, no, " ".join(said)))
    assert len(starts) == len(out)
    return out


def brute_paused(rows, pause):
    labels, words, out = Labels([(1, "Ann Bakker"), (2, "Bo Smid")]), WordTable(), []
    for tape in (1, 2):
        state, end, split, last, no = 0, None, False, None, 0
        for r in (r for r in rows if r[1] == tape):
            if r[5] is not None and end is not None and r[5] - end >= pause:
                split = True
            if r[3] and labels.get(r[3]):
                state = labels.get(r[3])
            for s, w in pieces(r[4], labels, words):
                state = state if s is None else s
                if w:
                    if last is None or last[2] != state or split:
                        no += 1
                        last = [tape, no, state, r[2], r[2], 0]
                        out.append(last)
                    last[4], last[5], split = r[2], last[5] + len(w), False
            end = max((x for x in (end, r[6]) if x is not None), default=None)
    return [tuple(x) for x in out]


@pytest.mark.parametrize("seed, chunk", [(5, 1), (5, 4), (5, 4096), (6, 2), (6, 7), (6, 50), (7, 3)])
def test_pauses_equal_one_pass(spark, seed, chunk):
    rows = paused_captions(seed)
    cap, spk = frames(spark, rows + rows[:50], [(1, t, n, name) for t in (1, 2) for n, name in ((1, "Ann Bakker"), (2, "Bo Smid"))])
    got = sorted((r.tape_no, r.turn_no, r.speaker_no, r.first_idx, r.last_idx, r.n_words) for r in turns.speaker_turns(cap, spk, pause_ms=600, chunk=chunk).collect())
    assert got == brute_paused(rows, 600)


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_calibrated_pauses_equal_one_pass(spark, chunk):
    import numpy as np

    rows = [(*r[:5], r[5] and r[5] * 30, r[6] and r[6] * 30) for r in paused_captions(8, 250)]
    gaps, end = [], {}
    for r in rows:
        if r[5] is not None and r[1] in end and r[5] > end[r[1]]:
            gaps.append(r[5] - end[r[1]])
        if r[6] is not None:
            end[r[1]] = max(r[6], end.get(r[1], r[6]))
    pause = max(1500, int(4 * np.sort(gaps)[(len(gaps) - 1) // 2]))
    assert min(gaps) < pause < max(gaps) and pause > 1500
    cap, spk = frames(spark, rows, [(1, t, n, name) for t in (1, 2) for n, name in ((1, "Ann Bakker"), (2, "Bo Smid"))])
    got = sorted((r.tape_no, r.turn_no, r.text) for r in turns.speaker_turns(cap, spk, with_text=True, pause_ms=turns.CALIBRATED, chunk=chunk).collect())
    assert got == brute_paused_texts(rows, pause)


def test_long_labels(spark):
    name = "Maria Johanna Wilhelmina Catharina Petronella Geertruida Adriana van der Oude Nieuwe Korte Lange Bakkersveld"
    cap, spk = frames(spark, [(1, 1, 0, None, f"{name}: ja", 0, 1), (1, 1, 1, None, "[INT" + " " * 300 + "] nee", 1, 2)], [(1, 1, 2, name), (1, 1, 1, "Bo Smid")])
    assert [(r.speaker_no, r.n_words) for r in turns.speaker_turns(cap, spk).orderBy("turn_no").collect()] == [(2, 1), (1, 1)]


def test_a_pause_before_a_caption_without_words_splits(spark):
    for text in ("(coughs)", "[gelach]", None, ""):
        rows = [(1, 1, 0, "INT", "wij gingen", 0, 1000), (1, 1, 1, None, text, 7000, 7500), (1, 1, 2, None, "naar huis", 7500, 8000)]
        cap, spk = frames(spark, rows)
        for chunk in (1, 2, 4096):
            got = turns.speaker_turns(cap, spk, pause_ms=1684, chunk=chunk).orderBy("turn_no").collect()
            assert [(r.first_idx, r.last_idx) for r in got] == [(0, 0), (2, 2)]


def test_nulls_in_any_column(spark):
    rows = [(None, None, 0, "INT", "wie was daar", None, None), (None, None, 1, None, "Wie was daar?", 5, None), (1, None, 3, None, None, None, None), (1, 1, None, None, "zoek", 1, 2), (1, 1, 4, None, "Bakker: ja ja", 1, 2)]
    cap, spk = frames(spark, rows, [(None, None, 1, "Ann Bakker"), (1, 1, 2, "Bo Bakker"), (1, 1, None, "x"), (1, 1, 1, None)])
    for limit in (ch.BROADCAST_SPEAKERS, 0):
        got = [(r.transcript_id, r.who) for r in ch.caption_chunks(cap, spk, 8, broadcast_rows=limit).collect()]
        assert sorted(got, key=str) == sorted([(None, "1\x1fAnn Bakker"), (None, "1\x1fAnn Bakker"), (1, None), (1, "2\x1fBo Bakker")], key=str)
    got = {(r.transcript_id, r.tape_no, r.speaker_no, r.n_words) for r in turns.speaker_turns(cap, spk).collect()}
    assert got == {(None, None, 1, 6), (1, 1, 2, 2)}
    assert [tuple(r) for r in runs.caption_runs(cap, spk).collect()] == [(None, None, 0, 1, 2, None)]


def test_a_hot_tape_is_spread(spark):
    cap, spk = frames(spark, [(1, 1, i, None, "ja", i, i + 1) for i in range(3000)])
    got = ch.caption_chunks(cap, spk, 100).select(F.spark_partition_id().alias("p"), "chunk", "caption_idx").collect()
    assert len({r.p for r in got}) > 1 and len(got) == 3000
    assert all(len({r.p for r in got if r.chunk == c}) == 1 for c in {r.chunk for r in got})
    assert [(r.first_idx, r.last_idx, r.n_captions) for r in runs.caption_runs(cap, spk, 100).collect()] == [(0, 2999, 3000)]
    assert [(r.first_idx, r.last_idx, r.n_words) for r in turns.speaker_turns(cap, spk, chunk=100).collect()] == [(0, 2999, 3000)]
