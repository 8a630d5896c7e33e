"""Problem 5: overlapping and gapped time intervals.

Method: an ordered map of disjoint intervals per entity is kept as keyed state; each insertion
locates the intervals it overlaps by binary search, merges them and so updates the gaps. The
same map serves batches here and streams in talespan.streaming.intervals.

Scale: the key of the batch is (entity, time block). Equal starts are first reduced to their
latest end, in every map task and then by start, so only distinct starts reach a block's task. It
holds at most as many intervals as it has milliseconds, however many rows an entity has. Blocks are stitched by windows over one row per block, so an
interval may reach over any number of blocks and no task holds a whole entity.

Cases: null or NaN times and intervals that do not end after they start are left out; adjoining
intervals merge; repeated rows change nothing; null entity keys form an entity of their own;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from talespan.runtime import materialize, shuffle_partitions

BLOCK_MS = 600_000


class IntervalMap:
    """Disjoint closed intervals in order; adjoining ones are merged."""

    __slots__ = ("starts", "ends")

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None):
        self.starts, self.ends = starts or [], ends or []

    def insert(self, start: int, end: int) -> None:
        lo = bisect_left(self.ends, start)
        hi = bisect_right(self.starts, end)
        if lo < hi:
            start, end = min(start, self.starts[lo]), max(end, self.ends[hi - 1])
        self.starts[lo:hi] = [start]
        self.ends[lo:hi] = [end]

    def gaps(self) -> list[tuple[int, int]]:
        return list(zip(self.ends[:-1], self.starts[1:]))


def valid_interval(start: Column, end: Column) -> Column:
    """Both times are numbers and the end is after the start."""
    return start.isNotNull() & end.isNotNull() & ~F.isnan(start.cast("double")) & ~F.isnan(end.cast("double")) & (end > start)


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """Per entity its merged periods and the gaps between them: keys, kind, start_ms, end_ms.
    ``start`` and ``end`` are integer milliseconds of valid intervals."""
    spark = df.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(*keys, F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"), F.floor(F.col(start) / F.lit(block_ms)).cast("bigint").alias("block"))
    reduced = rows.groupBy(*keys, "block", "s").agg(F.max("e").alias("e")).repartition(shuffle_partitions(spark), *keys, "block")

    n_keys = len(keys)

    def run(batches):
        """The keyed state of one (entity, block) at a time; its rows lie together."""
        key, held, out, schema = None, None, [], None

        def flush():
            cols = [pa.array([k[i] for k, m in out for _ in m.starts], schema.field(i).type) for i in range(n_keys + 1)]
            cols += [pa.array([x for _, m in out for x in m.starts], pa.int64()), pa.array([x for _, m in out for x in m.ends], pa.int64())]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, names=[*keys, "block", "s", "e"])

        for batch in batches:
            schema = batch.schema
            cols = [c.to_pylist() for c in batch.columns]
            for k, s, e in zip(zip(*cols[:n_keys + 1]), cols[n_keys + 1], cols[n_keys + 2]):
                if k != key:
                    key, held = k, IntervalMap()
                    out.append((k, held))
                held.insert(s, e)
            if len(out) > 20_000:
                last = out.pop()
                yield flush()
                out.append(last)
        if out:
            yield flush()

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", block bigint, s bigint, e bigint"
    local = materialize(reduced.sortWithinPartitions(*keys, "block").mapInArrow(run, schema), "intervals")

    entity = Window.partitionBy(*keys).orderBy("block")
    past = entity.rowsBetween(Window.unboundedPreceding, -1)
    later = entity.rowsBetween(1, Window.unboundedFollowing)
    blocks = local.groupBy(*keys, "block").agg(F.max("e").alias("last"))
    blocks = blocks.withColumn("carried", F.max("last").over(past)).withColumn("final", F.max("last").over(Window.partitionBy(*keys)))
    joined = _join(local, blocks, [*keys, "block"])
    within = Window.partitionBy(*keys, "block").orderBy("s")
    joined = joined.withColumn("before", F.greatest("carried", F.lag("e").over(within)))
    opens = joined.where("before IS NULL OR s > before").withColumn("next", F.lead("before").over(within))
    firsts = opens.groupBy(*keys, "block").agg(F.min("before").alias("opening"))
    firsts = firsts.withColumn("next_block", F.first("opening", ignorenulls=True).over(later)).drop("opening")
    full = _join(opens, firsts, [*keys, "block"])
    periods = full.select(*keys, F.lit("period").alias("kind"), F.col("s").alias("start_ms"), F.coalesce("next", "next_block", "final").alias("end_ms"))
    gaps = full.where("before IS NOT NULL").select(*keys, F.lit("gap").alias("kind"), F.col("before").alias("start_ms"), F.col("s").alias("end_ms"))
    return periods.unionByName(gaps)


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join on keys that may be null."""
    renamed = right.select(*[F.col(k).alias("r_" + k) for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col("r_" + k))
        cond = same if cond is None else cond & same
    return left.join(renamed, cond).drop(*["r_" + k for k in keys])


def segment_periods(segments: DataFrame) -> DataFrame:
    """Periods and gaps of each tape's segments in milliseconds. Times too large for whole
    milliseconds are left out like missing ones."""
    ms = lambda c: F.round(F.col(c).cast("double") * 1000).try_cast("bigint")
    ok = segments.where(valid_interval(F.col("start_s"), F.col("end_s"))).select("transcript_id", "tape_no", ms("start_s").alias("start_ms"), ms("end_s").alias("end_ms"))
    return merge_intervals(ok.where("start_ms IS NOT NULL AND end_ms IS NOT NULL"), ["transcript_id", "tape_no"])
