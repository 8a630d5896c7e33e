"""Merged periods and gaps over a stream of intervals: the keyed state is the disjoint map."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from talespan.operators.intervals import IntervalMap


def stream_periods(stream: DataFrame, keys: list[str]) -> DataFrame:
    """For each micro-batch the current periods and gaps of the entities it touched: keys, kind,
    start_ms, end_ms, version. ``stream``: keys, start_ms, end_ms of valid intervals. Late and
    repeated rows only merge; the highest version of an entity is its current state."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    columns = ", ".join(f"`{k}` {kinds[k]}" for k in keys)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        version, starts, ends = state.get if state.exists else (0, [], [])
        held = IntervalMap(list(starts), list(ends))
        for pdf in batches:
            for s, e in zip(pdf["start_ms"].tolist(), pdf["end_ms"].tolist()):
                held.insert(int(s), int(e))
        state.update((version + 1, held.starts, held.ends))
        rows = [("period", s, e) for s, e in zip(held.starts, held.ends)] + [("gap", s, e) for s, e in held.gaps()]
        out = pd.DataFrame(rows, columns=["kind", "start_ms", "end_ms"])
        for k, v in zip(keys, key):
            out[k] = v
        out["version"] = version + 1
        yield out[[*keys, "kind", "start_ms", "end_ms", "version"]]

    return stream.select(*keys, "start_ms", "end_ms").groupBy(*keys).applyInPandasWithState(
        update, f"{columns}, kind string, start_ms bigint, end_ms bigint, version bigint",
        "version bigint, starts array<bigint>, ends array<bigint>", "update", GroupStateTimeout.NoTimeout)
