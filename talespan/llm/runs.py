"""Problem 4: repeated consecutive events in sequences.

Method: events are canonicalised (speaker and words; near-identical neighbours take the same
value), then the row number within entity and value is subtracted from the row number within
the entity: constant differences identify runs.

Scale: the subtraction runs within bounded chunks of a tape (captionchunks.py). Runs inside a
chunk are final; only runs at chunk edges are written out with their edge words and stitched by
windows over those few rows, so a run may cross any number of chunks and no task holds a tape.

Cases: a caption without number is left out, as it has no place in the order; null transcript or
tape numbers form a tape of their own; null or wordless text ends a run; a caption with words of two speakers is no repeat;
null start or end gives a null duration; rows delivered twice count once; empty tables give no
runs; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.types import BooleanType
from pyspark.sql import DataFrame, Window, functions as F

from talespan.llm.captionchunks import CHUNK, KEYS, caption_chunks, labels_of, map_chunks
from talespan.llm.captiontext import WordTable, osa, pieces
from talespan.runtime import materialize

#: Differing words that two neighbours may have: two misspelled words in each.
MOST_DIFFERENT = 4
_MIXED = -1

_FIELDS = [("transcript_id", "bigint", pa.int64()), ("tape_no", "int", pa.int32()), ("chunk", "int", pa.int32()),
           ("run_no", "int", pa.int32()), ("edge", "boolean", pa.bool_()), ("link", "string", pa.string()),
           ("speaker", "int", pa.int32()), ("leaves", "int", pa.int32()), ("head", "string", pa.string()),
           ("tail", "string", pa.string()), ("first_idx", "int", pa.int32()), ("last_idx", "int", pa.int32()),
           ("n_captions", "bigint", pa.int64()), ("start_ms", "bigint", pa.int64()), ("end_ms", "bigint", pa.int64())]
_SCHEMA = ", ".join(f"{n} {t}" for n, t, _ in _FIELDS)
_ARROW = pa.schema([(n, t) for n, _, t in _FIELDS])


def _same_word(a: str, b: str) -> bool:
    """Equal, or spellings of one word: no digits, same first letter, one slip apart; two slips
    (one in each) in words of six letters or more."""
    if a == b:
        return True
    short = min(len(a), len(b))
    if short < 3 or a[0] != b[0] or any(c.isdigit() for c in a) or any(c.isdigit() for c in b):
        return False
    d = osa(a, b, 2)
    return d <= 1 and short >= 4 or d <= 2 and short >= 5 and (a[-1] == b[-1] or short >= 8)


def same_words(a: list[str], b: list[str]) -> bool:
    """Same words in the same order apart from at most four misspelled ones."""
    if len(a) != len(b) or not a:
        return False
    if a == b:
        return True
    differ = [(x, y) for x, y in zip(a, b) if x != y]
    return len(differ) <= MOST_DIFFERENT and all(_same_word(x, y) for x, y in differ)


def _runs():
    words = WordTable()

    def work(key, who, rows, emit):
        labels, state = labels_of(who), None
        n = len(rows)
        texts, speakers, values = [], [], np.empty(n, np.int64)
        seen: dict[tuple, int] = {}
        conditional = -1  # caption that joins its predecessor if its speaker is the one carried into the chunk
        for i, (idx, role, text, start, end) in enumerate(rows):
            got = pieces(text, labels, words)
            if role is not None and (r := labels.get(role)) is not None:
                state = r
            own, speaker = [], None
            for s, found in got:
                if s is not None:
                    state = s
                if found:
                    speaker = state if not own else speaker if speaker == state else _MIXED
                    own += [words.get(w) for w in found]
            texts.append(own)
            speakers.append(speaker)
            if not own or speaker == _MIXED:
                values[i] = -1 - i
            elif i and texts[i - 1] and speakers[i - 1] == speaker and same_words(texts[i - 1], own):
                values[i] = values[i - 1]
            else:
                values[i] = seen.setdefault((speaker, *own), i)
                if i and values[i] == values[i - 1]:  # the neighbour took this value by likeness, yet differs too much
                    values[i] = seen[(speaker, *own)] = i
                if i and speaker is not None and speakers[i - 1] is None and same_words(texts[i - 1], own):
                    conditional = i
        # Runs are the groups of equal value and equal difference between the row number and the row
        # number within the value: a value that comes again later has another difference there.
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        starts = np.r_[0, np.flatnonzero(np.diff(ranked)) + 1]
        within = np.empty(n, np.int64)
        within[order] = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
        run = np.stack([values, np.arange(n) - within])
        by_run = np.lexsort((np.arange(n), run[1], run[0]))
        cuts = np.flatnonzero((np.diff(run[:, by_run]) != 0).any(axis=0)) + 1
        heads, ends = by_run[np.r_[0, cuts]], by_run[np.r_[cuts, n] - 1]
        place = np.argsort(heads)
        heads, ends = heads[place], ends[place]
        last = len(heads) - 1
        for no, (h, e) in enumerate(zip(heads.tolist(), ends.tolist())):
            at_condition = h == conditional or e == conditional - 1
            edge = no == 0 or no == last or at_condition
            if not edge and e == h:
                continue
            link = "head" if no == 0 else "carry" if h == conditional else "no"
            emit((*key, no, edge, link, speakers[h], state if no == last else None,
                  " ".join(texts[h]) if edge else None, " ".join(texts[e]) if edge else None,
                  rows[h][0], rows[e][0], e - h + 1, rows[h][3], rows[e][4]))

    return work


@F.pandas_udf(BooleanType())
def _same(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([bool(x) and bool(y) and same_words(x.split(" "), y.split(" ")) for x, y in zip(a, b)], dtype=bool)


def caption_runs(captions: DataFrame, speakers: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Runs of two or more captions of one speaker with the same words: transcript_id, tape_no,
    first_idx, last_idx, n_captions, duration_ms."""
    chunks = caption_chunks(captions, speakers, chunk)
    parts = materialize(map_chunks(chunks, _runs(), _SCHEMA, _ARROW), "runs")
    keep = ["transcript_id", "tape_no", "first_idx", "last_idx", "n_captions", "start_ms", "end_ms"]
    tape = Window.partitionBy("transcript_id", "tape_no").orderBy("chunk", "run_no")
    # The speaker that a chunk inherits: "leaves" is set on a chunk's last run only, so looking
    # strictly before the chunk's own rows needs the previous chunks' last rows.
    edges = parts.where("edge")
    before = Window.partitionBy("transcript_id", "tape_no").orderBy("chunk").rangeBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("carry", F.coalesce(F.last("leaves", ignorenulls=True).over(before), F.lit(0)))
    edges = edges.withColumn("who", F.coalesce("speaker", "carry"))
    edges = edges.withColumn("prev_tail", F.lag("tail").over(tape)).withColumn("prev_who", F.lag("who").over(tape))
    edges = edges.withColumn("joined", (F.col("link") != "no") & (F.col("who") != _MIXED) & F.col("who").eqNullSafe(F.col("prev_who"))
                             & _same(F.col("prev_tail"), F.col("head")))
    edges = edges.withColumn("grp", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(tape))
    stitched = edges.groupBy("transcript_id", "tape_no", "grp").agg(
        F.min("first_idx").alias("first_idx"), F.max("last_idx").alias("last_idx"), F.sum("n_captions").alias("n_captions"),
        F.min(F.struct("first_idx", "start_ms"))["start_ms"].alias("start_ms"),
        F.max(F.struct("last_idx", "end_ms"))["end_ms"].alias("end_ms"),
    ).where("n_captions > 1")
    runs = parts.where("NOT edge AND n_captions > 1").select(*keep).unionByName(stitched.select(*keep))
    return runs.select("transcript_id", "tape_no", "first_idx", "last_idx", F.col("n_captions").cast("int").alias("n_captions"),
                       (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"))
