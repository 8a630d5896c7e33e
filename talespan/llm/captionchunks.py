"""Captions of each tape in bounded chunks that Python stages read in order.

A tape of any length is cut into chunks of ``CHUNK`` consecutive caption numbers, so no task
ever holds a whole tape: operators work within chunks and stitch the few chunk-edge rows with
windows. Rows delivered twice lie in one chunk and count once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from talespan.llm.captiontext import Labels
from talespan.runtime import shuffle_partitions

CHUNK = 4096
KEYS = ["transcript_id", "tape_no", "chunk"]
#: Speaker rows up to which the speakers are broadcast; beyond it they are joined per chunk.
BROADCAST_SPEAKERS = 100_000


def caption_chunks(captions: DataFrame, speakers: DataFrame, chunk: int = CHUNK, broadcast_rows: int = BROADCAST_SPEAKERS, ends: bool = False) -> DataFrame:
    """Captions with ``chunk`` and ``who`` (the tape's speakers as one string), each chunk
    whole and in order in one partition. With ``ends`` a first row without caption_idx gives in
    end_ms the latest end of the tape's chunks before, if there is one."""
    spark = captions.sparkSession
    captions = captions.where("caption_idx IS NOT NULL")  # without a number a caption has no place in the order
    cap = captions.select(
        "transcript_id", "tape_no", "caption_idx", "role", "text", "start_ms", "end_ms",
        F.floor(F.col("caption_idx") / F.lit(chunk)).cast("int").alias("chunk"),
    )
    if ends:
        past = Window.partitionBy("transcript_id", "tape_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        before = cap.groupBy(*KEYS).agg(F.max("end_ms").alias("own")).withColumn("end_ms", F.max("own").over(past)).where("end_ms IS NOT NULL")
        cap = cap.unionByName(before.drop("own"), allowMissingColumns=True)
    cap = cap.repartition(shuffle_partitions(spark), *KEYS)
    who = (speakers.where("speaker_no IS NOT NULL AND full_name IS NOT NULL")
           .groupBy(F.col("transcript_id").alias("w_t"), F.col("tape_no").alias("w_n"))
           .agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws("\x1f", F.col("speaker_no").cast("string"), "full_name"))), "\x1e").alias("who")))
    if speakers.count() <= broadcast_rows:
        cap = cap.join(F.broadcast(who), F.col("transcript_id").eqNullSafe(F.col("w_t")) & F.col("tape_no").eqNullSafe(F.col("w_n")), "left")
    else:
        keys = captions.select("transcript_id", "tape_no", F.floor(F.col("caption_idx") / F.lit(chunk)).cast("int").alias("chunk")).distinct()
        tape = F.col("transcript_id").eqNullSafe(F.col("w_t")) & F.col("tape_no").eqNullSafe(F.col("w_n"))
        per_chunk = keys.join(who, tape).select(*[F.col(k).alias("k_" + k) for k in KEYS], "who")
        same = [F.col(k).eqNullSafe(F.col("k_" + k)) for k in KEYS]
        cap = cap.join(per_chunk, same[0] & same[1] & same[2], "left")
    return cap.select(*KEYS, "caption_idx", "role", "text", "start_ms", "end_ms", "who").sortWithinPartitions(*KEYS, "caption_idx")


def labels_of(who: str | None) -> Labels:
    return Labels(tuple(x.split("\x1f", 1)) for x in who.split("\x1e")) if who else Labels()


def map_chunks(df: DataFrame, work: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """Call ``work(key, who, rows, emit)`` per chunk; ``rows``: (idx, role, text, start, end),
    one per caption number; ``emit`` takes output tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, who, rows = None, None, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [()] * len(arrow)
            got = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, arrow)], schema=arrow)
            out.clear()
            return got

        for batch in batches:
            t, n, c, idx, role, text, start, end = (batch.column(i).to_pylist() for i in range(8))
            whos = batch.column(8)
            for i in range(batch.num_rows):
                k = (t[i], n[i], c[i])
                if k != key:
                    if rows:
                        work(key, who, rows, out.append)
                    key, who, rows = k, whos[i].as_py(), []
                elif idx[i] == rows[-1][0] and idx[i] is not None:
                    continue
                rows.append((idx[i], role[i], text[i], start[i], end[i]))
            if len(out) > 20_000:
                yield flush()
        if rows:
            work(key, who, rows, out.append)
        if out:
            yield flush()

    return df.mapInArrow(run, schema)
