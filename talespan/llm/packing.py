"""Problem 8: filling fixed-capacity containers with items.

Method: variable-capacity best-fit. Items go, largest first, into the open container that they
leave the least space in; where none fits, the container size of least cost is opened, the cost
of a size being the share that would stay empty if the remaining items filled it greedily; in
the end each container is downsized to the smallest permitted capacity that holds its contents.

The plan 'mixed' uses all capacities jointly; one more plan per limit uses that capacity alone.

Scale: items are spread by a hash into groups of about ``GROUP`` items, packed independently
and spread over all tasks; only (id, size) is shuffled. A group leaves at most a container or so of slack,
far below a thousandth at this group size, and no group grows with the corpus.

Cases: null and empty texts measure 0 and join any container; an item above the largest capacity
of a plan is split into full parts and a rest, any other item never; repeated rows are items of
their own; no items give no containers; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from talespan.runtime import shuffle_partitions

GROUP = 10_000
MIXED = "mixed"


class _Remaining:
    """Sizes still to be placed: sorted distinct values with counts."""

    def __init__(self, sizes: np.ndarray):
        values, counts = np.unique(sizes, return_counts=True)
        self.values, self.counts = values.tolist(), counts.tolist()

    def take(self, size: int) -> None:
        i = bisect_left(self.values, size)
        self.counts[i] -= 1
        if not self.counts[i]:
            del self.values[i], self.counts[i]

    def filled(self, space: int) -> int:
        """How much of ``space`` the remaining items fill, largest fitting first."""
        left, i = space, len(self.values)
        while left > 0:
            i = bisect_right(self.values, left, 0, i) - 1
            if i < 0 or not self.values[i]:
                break
            left -= self.values[i] * min(self.counts[i], left // self.values[i])
        return space - left


def pack(sizes: np.ndarray, capacities: list[int]) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pack items into containers of the permitted capacities.

    Returns the placements (item, part, first unit of the part, length, container) and the
    final capacity of each container.
    """
    capacities = sorted(set(int(c) for c in capacities))
    largest = capacities[-1]
    placed, contents = [], []
    items: list[tuple[int, int, int, int]] = []  # size, item, part, first
    for i, n in enumerate(sizes.tolist()):
        part = 0
        first = 0
        if n > largest:
            while n - first > largest:
                placed.append((i, part, first, largest, len(contents)))
                contents.append(largest)
                part, first = part + 1, first + largest
        items.append((n - first, i, part, first))
    items.sort(key=lambda x: (-x[0], x[1]))
    rest = _Remaining(np.array([x[0] for x in items], np.int64))
    spaces: list[tuple[int, int]] = []  # (space left, container), sorted
    opened = [largest] * len(contents)
    for n, i, part, first in items:
        rest.take(n)
        at = bisect_left(spaces, (n, -1))
        if at < len(spaces):
            left, box = spaces.pop(at)
        else:
            left, box = _open(n, capacities, rest), len(contents)
            contents.append(0)
            opened.append(left)
        placed.append((i, part, first, n, box))
        contents[box] += n
        left -= n
        if left or not n:
            insort(spaces, (left, box))
    return placed, [capacities[bisect_left(capacities, c)] for c in contents]


def _open(n: int, capacities: list[int], rest: _Remaining) -> int:
    """The capacity of least cost to open for an item: smallest empty share, then largest."""
    fits = capacities[bisect_left(capacities, n):]
    if len(fits) == 1:
        return fits[0]
    return min(fits, key=lambda c: ((c - n - rest.filled(c - n)) / c, -c))


def pack_items(items: DataFrame, limits: list[tuple[str, int]], id_col: str = "doc_id", size_col: str = "n_tokens", group: int = GROUP, n_items: int | None = None) -> DataFrame:
    """One row per placed part and plan: plan, container_id, capacity_tokens, id_col, part_no,
    first_token, n_tokens. ``limits``: (name, capacity) pairs, at least one."""
    groups = max(1, -(-(items.count() if n_items is None else n_items) // group))
    kind = items.schema[id_col].dataType.simpleString()
    limits = sorted((n, int(c)) for n, c in limits if c and c > 0)
    if not limits:
        raise ValueError("no capacity is given")
    plans = [(n, [c]) for n, c in limits] + [(MIXED, [c for _, c in limits])]

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([id_col, size_col], na_position="first", kind="stable")
        ids, sizes, g = pdf[id_col].to_numpy(), pdf[size_col].to_numpy(np.int64), int(pdf["grp"].iloc[0])
        out = []
        for name, caps in plans:
            placed, capacity = pack(sizes, caps)
            p = np.array(placed, np.int64)
            out.append(pd.DataFrame({"plan": name, "container_id": (g << 32) + p[:, 4], "capacity_tokens": np.array(capacity)[p[:, 4]],
                                     id_col: ids[p[:, 0]], "part_no": p[:, 1], "first_token": p[:, 2], "n_tokens": p[:, 3]}))
        return pd.concat(out)

    keyed = items.select(id_col, F.col(size_col).cast("bigint").alias(size_col), F.pmod(F.xxhash64(id_col, size_col), F.lit(groups)).alias("grp"))
    # A fixed number of partitions: rows are tiny, so that adaptive merging would put all groups in one task.
    return keyed.repartition(shuffle_partitions(items.sparkSession), "grp").groupBy("grp").applyInPandas(
        work, f"plan string, container_id bigint, capacity_tokens int, `{id_col}` {kind}, part_no int, first_token bigint, n_tokens bigint")


def fill_report(packed: DataFrame) -> DataFrame:
    """Per plan: containers, their capacity, the tokens in them and the share filled."""
    boxes = packed.groupBy("plan", "container_id").agg(F.first("capacity_tokens").alias("cap"), F.sum("n_tokens").alias("n"))
    return boxes.groupBy("plan").agg(F.count("*").alias("n_containers"), F.sum(F.col("cap").cast("bigint")).alias("capacity_tokens"),
                                     F.sum("n").alias("n_tokens"), F.round(F.sum("n") / F.sum("cap"), 6).alias("fill"))
