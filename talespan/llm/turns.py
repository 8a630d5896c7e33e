"""Problem 6: speech transcripts into clean speaker turns.

Method: captions are swept in order; labels and roles set the speaker, rolling-caption
repetition is removed by suffix-prefix overlap, and turns split at speaker changes or at
calibrated pauses. One pass serves all: it splits at every gap that may prove a pause and lists
all gaps; their median then gives the length from which a gap counts, and stretches split at
shorter ones are joined again, all of them where turns are defined by speakers only.

Scale: chunks of a tape are read independently (captionchunks.py); each yields its stretches of
one speaker plus one summary row. Windows run over summary rows only (one per 4096 captions)
to carry the speaker, open pauses and the turn numbers across chunks; stretches that touch are merged by a
hash aggregation on (tape, turn). No task holds a tape. A stretch that may join the one before it also
gives its first captions as they came, so repeats across that edge are found when it is joined.

Cases: a caption without number is left out, as it has no place in the order; null transcript or
tape numbers form a tape of their own; null text or role counts as absent; a caption number delivered twice counts once; words
before any label or role belong to speaker 0; a label without words only changes the speaker;
a pause before a caption without words splits at the next words, in its chunk or a later one;
very long texts are read whole; empty tables give no turns; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from talespan.llm.captionchunks import CHUNK, KEYS, caption_chunks, labels_of, map_chunks
from talespan.llm.captiontext import WordTable, pieces
from talespan.runtime import materialize

CALIBRATED = "calibrated"
#: No gap below this is a pause.
LEAST_PAUSE_MS = 1500
#: How many times the median gap a pause lasts.
PAUSE_FACTOR = 4.0

_LONGS = pa.list_(pa.int64())
_FIELDS = [("transcript_id", "bigint", pa.int64()), ("tape_no", "int", pa.int32()), ("chunk", "int", pa.int32()),
           ("summary", "boolean", pa.bool_()), ("seq", "int", pa.int32()), ("turn_seq", "int", pa.int32()), ("speaker", "int", pa.int32()),
           ("first_idx", "int", pa.int32()), ("last_idx", "int", pa.int32()), ("n_words", "bigint", pa.int64()), ("start_ms", "bigint", pa.int64()), ("end_ms", "bigint", pa.int64()),
           ("text", "string", pa.string()), ("head", "string", pa.string()),
           ("first_spk", "int", pa.int32()), ("known_spk", "int", pa.int32()), ("last_spk", "int", pa.int32()), ("known", "int", pa.int32()),
           ("first_gap", "bigint", pa.int64()), ("known_gap", "bigint", pa.int64()), ("last_gap", "bigint", pa.int64()),
           ("soft_seqs", "array<bigint>", _LONGS), ("soft_gaps", "array<bigint>", _LONGS), ("gaps", "array<bigint>", _LONGS)]
_SCHEMA = ", ".join(f"{n} {t}" for n, t, _ in _FIELDS)
_ARROW = pa.schema([(n, t) for n, _, t in _FIELDS])


def overlap(tail: list[str], head: list[str]) -> int:
    """Words of the longest suffix of ``tail`` that is a prefix of ``head`` and makes up a
    rolling repeat: all of ``head``, or at least three words. Linear time by the prefix function."""
    tail = tail[-len(head):]
    if not head or head[0] not in tail:
        return 0
    border, k = [0] * len(head), 0
    for i in range(1, len(head)):
        while k and head[i] != head[k]:
            k = border[k - 1]
        k += head[i] == head[k]
        border[i] = k
    k = 0
    for w in tail:
        while k and w != head[k]:
            k = border[k - 1]
        k += w == head[k]
    return k if k >= 3 or k == len(head) and k > 1 else 0


def unrolled(said: list[list[str]], words: WordTable) -> tuple[list[str], int]:
    """Words of a stretch without rolling repeats, and how many of its captions must be compared
    anew when words precede it: those up to the last one longer than all since such a one before it."""
    out, plain, since, n_head = [], [], 0, 0
    for i, found in enumerate(said):
        own = [words.get(w) for w in found]
        k = overlap(plain[-len(own):], own)
        if len(own) > since:
            since, n_head = len(own), i + 1
        else:
            since += len(own) - k
        out.extend(found[k:])
        plain.extend(own[k:])
    return out, n_head


def _joined_text(parts: pd.Series) -> pd.Series:
    """One text of a turn's stretches in order, rolling repeats across their edges removed."""
    words = WordTable()

    def one(stretches) -> str | None:
        if stretches is None:
            return None
        out, plain = [], []
        for i, x in enumerate(stretches):
            own, said = x["text"].split(" "), []
            if i:
                said = [c.split(" ") for c in x["head"].split("\n")]
                own = own[len(unrolled(said, words)[0]):]
            for found in said:
                head = [words.get(w) for w in found]
                k = overlap(plain[-len(head):], head)
                out.extend(found[k:])
                plain.extend(head[k:])
            out.extend(own)
            plain.extend(words.get(w) for w in own)
        return " ".join(out)

    return parts.map(one)


def _stretches(least: int):
    """Work on one chunk: stretches of one speaker without a gap of ``least`` ms or more, then a
    summary. A stretch is [speaker, first, last, words, start, end, captions' words, gap before]."""
    words = WordTable()

    def work(key, who, rows, emit):
        labels = labels_of(who)
        state, out, gap = None, [], None
        last_end = rows[0][4] if rows[0][0] is None else None  # of the chunks before, see caption_chunks
        known = None  # the first stretch whose speaker is known here
        soft, gaps = [], []
        for idx, role, text, start, end in rows:
            if idx is None:
                continue
            got = pieces(text, labels, words)
            if role is not None and (r := labels.get(role)) is not None:
                state = r
            if start is not None and last_end is not None and start > last_end:
                gaps.append(start - last_end)
                gap = max(gap or 0, start - last_end)
            for speaker, found in got:
                if speaker is not None:
                    state = speaker
                if not found:
                    continue
                pause = gap if gap is not None and gap >= least else None
                if out and out[-1][0] == state and pause is None:
                    s = out[-1]
                    s[2], s[3] = idx, s[3] + len(found)
                else:
                    if out and out[-1][0] == state:
                        soft.append(len(out))
                    s = [state, idx, idx, len(found), start, None, [], pause]
                    out.append(s)
                    if known is None and state is not None:
                        known = len(out) - 1
                gap = None
                if end is not None:
                    s[5] = end if s[5] is None else max(s[5], end)
                s[6].append(found)
            if end is not None:
                last_end = end if last_end is None else max(last_end, end)
        may_join, turn = {0, known, *soft}, -1
        for seq, s in enumerate(out):
            turn += not seq or s[0] != out[seq - 1][0]
            got, n_head = unrolled(s[6], words)
            head = "\n".join(" ".join(w) for w in s[6][:n_head]) if seq in may_join else None
            emit((*key, False, seq, turn, s[0], s[1], s[2], s[3], s[4], s[5], " ".join(got), head, *[None] * 10))
        n = len(out)
        emit((*key, True, n, turn + 1, state, *[None] * 7, out[0][0] if n else None, out[known][0] if known is not None else None, out[-1][0] if n else None, known,
              out[0][7] if n else None, out[known][7] if known is not None else None, gap, soft, [out[i][7] for i in soft], gaps))

    return work


def calibrated_pause(parts: DataFrame, factor: float = PAUSE_FACTOR, least_ms: int = LEAST_PAUSE_MS) -> int:
    """A pause length from all gaps between captions: ``factor`` times their median (approximate
    percentile), at least ``least_ms``. ``parts``: the rows of the chunk pass."""
    mid = parts.where("summary").select(F.explode("gaps").alias("gap")).agg(F.percentile_approx("gap", 0.5, 1000)).first()[0]
    return max(least_ms, int(factor * (mid or 0)))


def speaker_turns(captions: DataFrame, speakers: DataFrame, *, with_text: bool = False, pause_ms: int | str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Turns per tape: transcript_id, tape_no, turn_no, speaker_no, first_idx, last_idx,
    n_words, and with ``with_text`` also start_ms, end_ms and the joined text without rolling
    repeats. ``pause_ms`` also splits a turn where a pause is at least that long, CALIBRATED where
    it is long against the gaps of all captions."""
    least = LEAST_PAUSE_MS if pause_ms is None or pause_ms == CALIBRATED else pause_ms
    chunks = caption_chunks(captions, speakers, chunk, ends=True)
    parts = materialize(map_chunks(chunks, _stretches(least), _SCHEMA, _ARROW), "turns")
    if pause_ms == CALIBRATED:
        pause_ms = calibrated_pause(parts)
    splits = pause_ms is not None
    long = lambda c: F.coalesce(F.col(c) >= F.lit(pause_ms), F.lit(False)) if splits else F.lit(False)
    # Stretches split at a gap that is no pause count as one with the stretch before.
    short = F.filter(F.arrays_zip("soft_seqs", "soft_gaps"), lambda x: x["soft_gaps"] < F.lit(pause_ms))["soft_seqs"] if splits else F.array().cast("array<bigint>")
    tape = Window.partitionBy("transcript_id", "tape_no").orderBy("chunk")
    past = tape.rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.where("summary").select(
        *KEYS, (F.col("seq") - F.size(short) if splits else F.col("turn_seq")).alias("n"), "first_spk", F.when(~long("known_gap"), F.col("known_spk")).alias("known_spk"), "last_spk", "known",
        short.alias("short"), F.coalesce(F.last("speaker", ignorenulls=True).over(past), F.lit(0)).alias("carry"),
        long("first_gap").alias("first_pause"), F.max(F.when(long("last_gap"), F.col("chunk"))).over(past).alias("open_pause"),
        F.max(F.when(F.col("seq") > 0, F.col("chunk"))).over(past).alias("spoken"),
    )
    carried = carried.withColumn("paused", F.col("first_pause") | F.coalesce(F.col("open_pause") >= F.col("spoken"), F.lit(False)))
    carried = carried.withColumn("tail_spk", F.when(F.col("n") > 0, F.coalesce("last_spk", "carry")))
    carried = carried.withColumn("prev_spk", F.last("tail_spk", ignorenulls=True).over(past))
    carried = carried.withColumn(
        "joins", F.when((F.col("n") > 0) & (F.coalesce("first_spk", "carry") == F.col("prev_spk")) & ~F.col("paused"), 1).otherwise(0)
    ).withColumn(
        "joins2", F.when((F.col("known_spk") == F.col("carry")) & (F.col("known") > 0), 1).otherwise(0)
    )
    carried = carried.withColumn("before", F.coalesce(F.sum(F.col("n") - F.col("joins") - F.col("joins2")).over(past), F.lit(0)))
    carried = carried.select(*[F.col(k).alias("k_" + k) for k in KEYS], "carry", "joins", "joins2", "before", "short", F.col("known").alias("k_known"))
    same = [F.col(k).eqNullSafe(F.col("k_" + k)) for k in KEYS]
    place = F.col("seq") - F.size(F.filter("short", lambda x: x <= F.col("seq"))) if splits else F.col("turn_seq")
    numbered = parts.where("NOT summary").join(carried, same[0] & same[1] & same[2]).select(
        "transcript_id", "tape_no", "first_idx", "last_idx", "n_words", "chunk", "seq", "start_ms", "end_ms", "text", "head",
        F.coalesce("speaker", "carry").alias("speaker_no"),
        (F.col("before") + place + 1 - F.col("joins") - F.when(F.col("seq") >= F.col("k_known"), F.col("joins2")).otherwise(0)).cast("int").alias("turn_no"),
    )
    aggs = [F.first("speaker_no").cast("int").alias("speaker_no"), F.min("first_idx").alias("first_idx"),
            F.max("last_idx").alias("last_idx"), F.sum("n_words").cast("int").alias("n_words")]
    if with_text:
        aggs += [F.min_by("start_ms", "first_idx").alias("start_ms"), F.max("end_ms").alias("end_ms"),
                 F.array_sort(F.collect_list(F.struct("chunk", "seq", "text", "head"))).alias("parts")]
    turns = numbered.groupBy("transcript_id", "tape_no", "turn_no").agg(*aggs)
    if with_text:
        across = F.pandas_udf(_joined_text, "string")(F.when(F.size("parts") > 1, F.col("parts")))
        turns = turns.withColumn("text", F.coalesce(across, F.col("parts")[0]["text"]))
    keep = ["transcript_id", "tape_no", "turn_no", "speaker_no", "first_idx", "last_idx", "n_words"]
    return turns.select(*keep, *(["start_ms", "end_ms", "text"] if with_text else []))
