"""Problem 3: parent-child links to full hierarchies.

Method: tree contraction. Rounds alternate raking (a leaf with one parent is folded into it) and
compressing (a node with one parent and one child is spliced out where a fresh hash of its id
exceeds those of both). Every removal is recorded. What neither step can remove is the core:
roots, nodes with several parents, what leads to them, and cycles, which never terminate and so
are exposed there. The core is solved, then the records are reversed round by round to recover
root, depth, path, descendants and cycle membership of all nodes.

Scale: no step changes how many parents a node has, so a node with one parent carries its link in
its own row. A round counts children by parent with map-side combine, joins the counts to the rows
and tells the children of spliced nodes their new parent; it is written as one stage table.
Rows shrink geometrically, so a chain of any length takes logarithmically many rounds. Once at most
``local_edges`` edges are left (a documented bound; the default is a few MB) the same contraction is
finished in one task. A core beyond that bound is closed by distributed doubling. Paths are carried
only where they are asked for.

Cases: null, blank and unknown link targets are no links; repeated rows and links count once;
a node that lists itself is in a cycle and no root; null ids are dropped; of several roots or
shortest parents the smallest id wins; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from talespan.functions.uris import uri_key
from talespan.runtime import materialize, release

#: Remaining edges that one task finishes.
LOCAL_EDGES = 20_000
_STATE = "id int, root int, depth int, path array<int>, total bigint, cycle int, scc int"


def concept_edges(concepts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: id; edges: p, c) of concept rows with concept_idx, uri and narrower."""
    rows = concepts.where("concept_idx IS NOT NULL").select(F.col("concept_idx").cast("int").alias("id"), uri_key(F.col("uri")).alias("key"), "narrower")
    links = rows.select("id", F.explode("narrower").alias("n")).select(F.col("id").alias("p"), uri_key(F.col("n")).alias("key")).where("key IS NOT NULL")
    named = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("c"))
    return rows.select("id").distinct(), links.join(named, "key").select("p", "c").distinct()


# --- the core and small remainders, in one task -------------------------------------------


def solve_local(edges: list[tuple[int, int, int, int, list[int]]], raked: dict[int, int], paths: bool = True) -> list[tuple]:
    """Contracts a small graph, solves its core and reverses the contraction.

    ``edges``: (parent, child, length, nodes hidden inside with what they raked, path of the
    hidden nodes); ``raked``: nodes already folded into a node. Returns _STATE tuples, whose
    paths are empty without ``paths``.
    """
    raked = defaultdict(int, raked)
    out_of: dict[int, dict[int, tuple]] = defaultdict(dict)  # node -> edge number -> edge
    into: dict[int, dict[int, tuple]] = defaultdict(dict)
    number = 0

    def add(e: tuple) -> None:
        nonlocal number
        out_of[e[0]][number] = e
        into[e[1]][number] = e
        number += 1

    def drop(k: int, e: tuple) -> None:
        del out_of[e[0]][k], into[e[1]][k]

    for e in edges:
        add((e[0], e[1], e[2], e[3], [int(x) for x in e[4]]))
    nodes = sorted(set(out_of) | set(into))
    records, queue = [], list(reversed(nodes))
    gone = set()
    while queue:
        v = queue.pop()
        if v in gone or len(into[v]) != 1 or len(out_of[v]) > 1:
            continue
        (k, e), = into[v].items()
        p = e[0]
        if p == v:
            continue
        if not out_of[v]:
            drop(k, e)
            raked[p] += 1 + raked[v] + e[3]
            records.append(("rake", v, p, e[2], e[4], None, 0, raked[v]))
        else:
            (k2, e2), = out_of[v].items()
            drop(k, e)
            drop(k2, e2)
            add((p, e2[1], e[2] + e2[2], e[3] + 1 + raked[v] + e2[3], [*e[4], v, *e2[4]] if paths else []))
            records.append(("compress", v, p, e[2], e[4], e2[1], e2[3], raked[v]))
            queue.append(e2[1])
        gone.add(v)
        queue.append(p)
    state = _solve_core([v for v in nodes if v not in gone], out_of, into, raked, paths)
    for kind, v, p, w, hidden, c, inner, own in reversed(records):
        _, root, depth, path, _, _, scc = state[p]
        depth = depth + w if depth >= 0 else -1
        path = [*path, *hidden, v] if paths and depth >= 0 else []
        if kind == "rake":
            state[v] = (v, root, depth, path, own, 0, v)
        elif state[p][6] == state[c][6] and state[p][5]:
            state[v] = (v, root, depth, path, state[c][4], 1, scc)
        else:
            state[v] = (v, root, depth, path, own + inner + (0 if state[c][5] else 1) + state[c][4], 0, v)
    return list(state.values())


def _solve_core(nodes: list[int], out_of, into, raked, paths: bool = True) -> dict[int, tuple]:
    """Shortest root paths, components and reachable counts of what contraction leaves."""
    best: dict[int, tuple] = {}
    heap = [(0, v, v, (v,) if paths else ()) for v in nodes if not into[v]]
    heapq.heapify(heap)
    while heap:
        d, root, v, path = heapq.heappop(heap)
        if v in best:
            continue
        best[v] = (root, d, list(path))
        for _, c, w, _, hidden in out_of[v].values():
            if c not in best:
                heapq.heappush(heap, (d + w, root, c, (*path, *hidden, c) if paths else ()))
    scc = _components(nodes, out_of)
    members = defaultdict(list)
    for v in nodes:
        members[scc[v]].append(v)
    spot = {v: i for i, v in enumerate(nodes)}
    weights = [1 + raked[v] for v in nodes]
    extra: dict[int, int] = {}  # bit of an edge with hidden nodes
    for v in nodes:
        for k, e in out_of[v].items():
            if e[3]:
                extra[k] = len(weights)
                weights.append(e[3])
    weigh = np.array(weights, np.int64)
    size = -(-len(weights) // 8) or 1
    reach: dict[int, int] = {}
    cyclic: dict[int, bool] = {}
    totals: dict[int, int] = {}
    for comp in _topological(nodes, out_of, scc, members):
        inside = members[comp]
        cyclic[comp] = len(inside) > 1 or any(e[1] == inside[0] for e in out_of[inside[0]].values())
        bits = 0
        for v in inside:
            if cyclic[comp]:
                bits |= 1 << spot[v]
            for k, e in out_of[v].items():
                if k in extra:
                    bits |= 1 << extra[k]
                if scc[e[1]] != comp:
                    bits |= reach[scc[e[1]]] | 1 << spot[e[1]]
        reach[comp] = bits
        on = np.unpackbits(np.frombuffer(bits.to_bytes(size, "little"), np.uint8), bitorder="little")[: len(weigh)]
        totals[comp] = int(weigh[on.astype(bool)].sum())
    state = {}
    for v in nodes:
        root, depth, path = best.get(v, (-1, -1, []))
        c = scc[v]
        total = totals[c] + (0 if cyclic[c] else raked[v])
        state[v] = (v, root, depth, path, total, int(cyclic[c]), c)
    return state


def _components(nodes, out_of) -> dict[int, int]:
    """Strongly connected components (iterative); a component is named by its smallest node."""
    index: dict[int, int] = {}
    low: dict[int, int] = {}
    on, stack, name = set(), [], {}
    for start in nodes:
        if start in index:
            continue
        work = [(start, iter([e[1] for e in out_of[start].values()]))]
        index[start] = low[start] = len(index)
        stack.append(start)
        on.add(start)
        while work:
            v, it = work[-1]
            for c in it:
                if c not in index:
                    index[c] = low[c] = len(index)
                    stack.append(c)
                    on.add(c)
                    work.append((c, iter([e[1] for e in out_of[c].values()])))
                    break
                if c in on:
                    low[v] = min(low[v], index[c])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
                if low[v] == index[v]:
                    comp = []
                    while True:
                        c = stack.pop()
                        on.discard(c)
                        comp.append(c)
                        if c == v:
                            break
                    for c in comp:
                        name[c] = min(comp)
    return name


def _topological(nodes, out_of, scc, members) -> list[int]:
    """Components, each after all it leads to."""
    waits, back = {}, defaultdict(set)
    for comp, inside in members.items():
        to = {scc[e[1]] for v in inside for e in out_of[v].values()} - {comp}
        waits[comp] = len(to)
        for t in to:
            back[t].add(comp)
    ready = [c for c, n in waits.items() if not n]
    order = []
    while ready:
        c = ready.pop()
        order.append(c)
        for b in back[c]:
            waits[b] -= 1
            if not waits[b]:
                ready.append(b)
    return order


def local_ancestors(edges: list[tuple[int, int, list[int]]]):
    """(node, all that lead to it) of a small graph whose edges (parent, child, hidden nodes) hide
    nodes; a node on a cycle is among its own ancestors. Gives one node at a time."""
    out_of: dict[int, dict[int, tuple]] = defaultdict(dict)
    for k, e in enumerate(edges):
        out_of[e[0]][k] = e
    nodes = sorted({e[0] for e in edges} | {e[1] for e in edges})
    scc = _components(nodes, out_of)
    members = defaultdict(list)
    for v in nodes:
        members[scc[v]].append(v)
    spot = {v: i for i, v in enumerate(nodes)}
    names: list[list[int]] = [[v] for v in nodes]
    into: dict[int, list[tuple[int, int]]] = defaultdict(list)  # component -> (parent, bits of parent and hidden nodes)
    inside: dict[int, int] = defaultdict(int)
    for a, c, hidden in edges:
        bits = 1 << spot[a]
        if len(hidden):
            bits |= 1 << len(names)
            names.append([int(x) for x in hidden])
        if scc[a] == scc[c]:
            inside[scc[a]] |= bits
        else:
            into[scc[c]].append((a, bits))
    above: dict[int, int] = {}
    size = -(-len(names) // 8) or 1
    for comp in reversed(_topological(nodes, out_of, scc, members)):
        bits = inside[comp]
        for a, own in into[comp]:
            bits |= above[scc[a]] | own
        above[comp] = bits
        on = np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(size, "little"), np.uint8), bitorder="little"))
        led = [x for i in on.tolist() for x in names[i]]
        for v in members[comp]:
            yield v, led


# --- distributed rounds --------------------------------------------------------------------

_KEEP, _RAKE, _SPLICE = 0, 1, 2


def _hidden(paths: bool, column: Column) -> list[Column]:
    return [column.alias("hidden")] if paths else []


def _write(rows: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """The rows as a stage table, and how many edges, rakes, splices and candidates they hold;
    counted while they are written."""
    seen = Observation()
    one = lambda test: F.coalesce(F.sum(F.when(F.expr(test), 1).otherwise(0)), F.lit(0))
    table = materialize(rows.observe(seen, one(f"kind = {_KEEP} AND p IS NOT NULL").alias("edges"), one(f"kind = {_KEEP} AND NOT node").alias("shared"),
                                     one(f"kind = {_RAKE}").alias("rakes"), one(f"kind = {_SPLICE}").alias("splices"), one("chain").alias("chains")), name)
    return table, seen.get


def _first(nodes: DataFrame, edges: DataFrame, paths: bool) -> tuple[DataFrame, dict[str, int]]:
    """The rows that the rounds work on: one per node, with its link if it has one parent, and
    one per edge into a node with several parents."""
    edges = materialize(edges.select("p", "c"), "hier-edges")
    parents = edges.groupBy(F.col("c").alias("e_c")).agg(F.count("*").alias("n"), F.max("p").alias("e_p"))
    empty = F.array().cast("array<int>")
    rest = [F.lit(1).alias("w"), F.lit(0).cast("bigint").alias("inner"), F.lit(0).cast("bigint").alias("raked"), F.lit(None).cast("int").alias("c"),
            F.lit(0).cast("bigint").alias("inner2"), F.lit(False).alias("chain"), F.lit(0).alias("k"), *_hidden(paths, empty)]
    own = nodes.join(parents, F.col("id") == F.col("e_c"), "left").select(
        F.lit(_KEEP).alias("kind"), F.lit(True).alias("node"), F.coalesce(F.col("n") > 1, F.lit(False)).alias("multi"), F.col("id").alias("v"), F.when(F.col("n") == 1, F.col("e_p")).alias("p"), *rest)
    shared = edges.join(parents.where("n > 1").select("e_c"), F.col("c") == F.col("e_c")).select(
        F.lit(_KEEP).alias("kind"), F.lit(False).alias("node"), F.lit(True).alias("multi"), F.col("c").alias("v"), "p", *rest)
    return _write(own.unionByName(shared), "hier-start")


def _round(rows: DataFrame, shared: bool, paths: bool, k: int) -> tuple[DataFrame, dict[str, int]]:
    """One rake and one compress step over the rows of the round before. ``shared``: whether
    edges into nodes with several parents are left."""
    kept = rows.where(F.col("kind") == _KEEP)
    # Children by parent; what was raked last round comes along as mail.
    child = lambda c: F.when(F.col("kind") == _KEEP, c)
    below = rows.where(f"kind <> {_SPLICE} AND p IS NOT NULL").select(
        F.col("p").alias("b_p"), child(F.lit(1)).otherwise(0).alias("o"), child(F.col("v")).alias("b_c"), child(F.col("inner")).alias("b_i"), child(F.col("multi")).alias("b_m"),
        F.when(F.col("kind") == _RAKE, F.col("raked") + F.col("inner") + 1).otherwise(0).alias("mail"),
    ).groupBy("b_p").agg(F.sum("o").alias("o"), F.max("b_c").alias("b_c"), F.max("b_i").alias("b_i"), F.max("b_m").alias("b_m"), F.sum("mail").alias("mail"))
    hash_ = lambda x: F.xxhash64(F.col(x), F.col("k"))
    held = F.col("p").isNotNull() & (F.col("p") != F.col("v"))
    hidden = ["hidden"] if paths else []
    x = kept.where("node").drop("c", "inner2", "chain").join(below.hint("shuffle_hash"), F.col("v") == F.col("b_p"), "left").select(
        "multi", "v", "p", "w", "inner", "k", (F.col("raked") + F.coalesce("mail", F.lit(0))).alias("raked"), F.col("b_c").alias("c"), F.col("b_i").alias("inner2"), "b_m",
        (held & (F.coalesce("o", F.lit(0)) == 0)).alias("leaf"), (held & (F.coalesce("o", F.lit(0)) == 1)).alias("chain"), *hidden)
    x = x.withColumn("out", F.coalesce(F.col("chain") & (hash_("v") > hash_("p")) & (hash_("v") > hash_("c")), F.lit(False)))
    spliced = x.where("out").select(F.col("c").alias("s_c"), "b_m", F.col("v").alias("s_v"), F.col("p").alias("s_p"), F.col("w").alias("s_w"),
                                    (F.col("inner") + 1 + F.col("raked")).alias("s_i"), *([F.col("hidden").alias("s_h")] if paths else []))
    told = F.col("s_v").isNotNull()
    moved = [F.coalesce("s_p", "p").alias("p"), (F.col("w") + F.coalesce("s_w", F.lit(0))).alias("w"), (F.col("inner") + F.coalesce("s_i", F.lit(0))).alias("inner")]
    longer = _hidden(paths, F.when(told, F.concat("s_h", F.array("s_v"), "hidden")).otherwise(F.col("hidden")) if paths else F.lit(0))
    # The parent of a leaf may be spliced out in the same round; such a leaf stays for the next.
    new = x.join(spliced.where("NOT b_m").hint("shuffle_hash"), F.col("v") == F.col("s_c"), "left").select(
        F.when(F.col("out"), _SPLICE).when(F.col("leaf") & ~told, _RAKE).otherwise(_KEEP).alias("kind"), F.lit(True).alias("node"), "multi", "v", *moved, "raked", "c", "inner2",
        "chain", (F.col("k") + 1).alias("k"), *longer)
    if shared:
        new = new.unionByName(kept.where("NOT node").drop("c", "inner2", "chain").join(spliced.where("b_m").hint("shuffle_hash"), F.col("p") == F.col("s_v"), "left").select(
            "kind", "node", "multi", "v", *moved, "raked", F.lit(None).cast("int").alias("c"), F.lit(0).cast("bigint").alias("inner2"), F.lit(False).alias("chain"), (F.col("k") + 1).alias("k"), *longer))
    return _write(new, f"hier-round-{k}")


def contract(nodes: DataFrame, edges: DataFrame, local_edges: int, paths: bool):
    """Rake and compress until at most ``local_edges`` edges or only the core is left:
    ([(records, number of splices) per round], remaining edges, remaining nodes with what they
    raked and whether they are roots, number of remaining edges)."""
    rows, seen = _first(nodes, edges, paths)
    records, k = [], 0
    while seen["edges"] > local_edges:
        before = rows
        rows, seen = _round(before, seen["shared"] > 0, paths, k)
        if not k:
            release(before)  # holds no records
        if seen["rakes"] or seen["splices"]:
            records.append((rows.where(F.col("kind") != _KEEP), seen["splices"]))
        elif not seen["chains"]:
            break
        k += 1
    kept = rows.where(F.col("kind") == _KEEP)
    mail = rows.where(F.col("kind") == _RAKE).groupBy(F.col("p").alias("m_p")).agg(F.sum(F.col("raked") + F.col("inner") + 1).alias("mail"))
    left = kept.where("p IS NOT NULL").select("p", F.col("v").alias("c"), "w", "inner", F.col("hidden") if paths else F.array().cast("array<int>").alias("hidden"))
    own = kept.where("node").join(mail, F.col("v") == F.col("m_p"), "left").select(F.col("v").alias("id"), (F.col("raked") + F.coalesce("mail", F.lit(0))).alias("raked"),
                                                                                  (F.col("p").isNull() & ~F.col("multi")).alias("root"))
    return records, left, own, seen["edges"]


def _reverse(records: DataFrame, splices: int, state: DataFrame, paths: bool) -> DataFrame:
    """States of the nodes that one round removed, from those of their neighbours."""
    hashed = (lambda df: df) if paths else (lambda df: df.hint("shuffle_hash"))  # states are narrow without paths
    of_p = hashed(state.select(F.col("id").alias("p"), "root", "depth", *(["path"] if paths else []), F.col("cycle").alias("p_cycle"), F.col("scc").alias("p_scc")))
    known = F.col("depth") >= 0
    place = ["root", F.when(known, F.col("depth") + F.col("w")).otherwise(-1).alias("depth")]
    if paths:
        place.append(F.when(known, F.concat("path", "hidden", F.array("v"))).otherwise(F.array().cast("array<int>")).alias("path"))
    out = records.where(F.col("kind") == _RAKE).join(of_p, "p").select(F.col("v").alias("id"), *place, F.col("raked").alias("total"), F.lit(0).alias("cycle"), F.col("v").alias("scc"))
    if splices:
        of_c = hashed(state.select(F.col("id").alias("c"), F.col("total").alias("c_total"), F.col("cycle").alias("c_cycle"), F.col("scc").alias("c_scc")))
        x = records.where(F.col("kind") == _SPLICE).join(of_p, "p").join(of_c, "c")
        on_cycle = (F.col("p_scc") == F.col("c_scc")) & (F.col("p_cycle") == 1)
        out = out.unionByName(x.select(
            F.col("v").alias("id"), *place, F.when(on_cycle, F.col("c_total")).otherwise(F.col("raked") + F.col("inner2") + 1 - F.col("c_cycle") + F.col("c_total")).cast("bigint").alias("total"),
            on_cycle.cast("int").alias("cycle"), F.when(on_cycle, F.col("p_scc")).otherwise(F.col("v")).alias("scc")))
    return out


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("p").alias("id")).union(edges.select("c")).distinct()


def _finish(edges: DataFrame, own: DataFrame, paths: bool) -> DataFrame:
    """The remaining graph in one task; its size was checked."""
    folded = _ends(edges).join(own.where("raked > 0"), "id").select(F.col("id").alias("p"), F.lit(None).cast("int").alias("c"), F.lit(0).alias("w"), F.col("raked").alias("inner"),
                                                                    F.array().cast("array<int>").alias("hidden"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        lone = pdf["c"].isna()
        extra = dict(zip(pdf.loc[lone, "p"].astype(int), pdf.loc[lone, "inner"].astype(int)))
        rows = pdf[~lone]
        links = sorted(zip(rows["p"].astype(int), rows["c"].astype(int), rows["w"].astype(int), rows["inner"].astype(int), map(list, rows["hidden"])))
        return pd.DataFrame(solve_local(links, extra, paths), columns=["id", "root", "depth", "path", "total", "cycle", "scc"])

    return edges.unionByName(folded).withColumn("one", F.lit(1)).groupBy("one").applyInPandas(solve, _STATE)


def _core(edges: DataFrame, raked: DataFrame) -> DataFrame:
    """A core too large for one task: distances by relaxation, reach by distributed doubling."""
    pairs = descendant_pairs(edges.select("p", "c").distinct())
    ids = edges.select(F.col("p").alias("id")).union(edges.select("c")).distinct()
    state = materialize(ids.join(edges.select(F.col("c").alias("id")).distinct(), "id", "left_anti").select(
        "id", F.col("id").alias("root"), F.lit(0).alias("depth"), F.array("id").alias("path")), "core-roots")
    n = None
    while True:
        step = state.join(edges, F.col("id") == F.col("p")).select(F.col("c").alias("id"), "root", (F.col("depth") + F.col("w")).alias("depth"),
                                                                     F.concat("path", "hidden", F.array("c")).alias("path"))
        new = materialize(state.unionByName(step).groupBy("id").agg(F.min(F.struct("depth", "root", "path")).alias("s")).select("id", "s.root", "s.depth", "s.path"), "core-relax")
        mark = tuple(new.agg(F.count("*"), F.sum("depth"), F.sum("root"), F.bit_xor(F.xxhash64("path"))).first())
        if mark == n:
            break
        state, n = new, mark
    back = pairs.select(F.col("d").alias("a"), F.col("a").alias("d"))
    mutual = pairs.join(back, ["a", "d"])
    scc = ids.join(mutual.groupBy(F.col("a").alias("id")).agg(F.min("d").alias("low")), "id", "left").select(
        "id", F.col("low").isNotNull().cast("int").alias("cycle"), F.least(F.coalesce("low", "id"), F.col("id")).alias("scc"))
    weight = ids.join(raked, "id", "left").select("id", (1 + F.coalesce("raked", F.lit(0))).alias("weight"))
    reached = pairs.join(weight, F.col("d") == F.col("id")).groupBy("a").agg(F.sum("weight").alias("n"))
    inner = edges.groupBy("p").agg(F.sum("inner").alias("inner"))
    own_inner = inner.select(F.col("p").alias("a"), "inner")
    through = pairs.join(inner, F.col("d") == F.col("p")).select("a", "inner").unionByName(
        own_inner.join(mutual.where("a = d").select("a"), "a", "left_anti")).groupBy("a").agg(F.sum("inner").alias("m"))
    full = ids.join(state, "id", "left").join(scc, "id").join(weight, "id").join(reached.withColumnRenamed("a", "id"), "id", "left").join(through.withColumnRenamed("a", "id"), "id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return full.select("id", F.coalesce("root", F.lit(-1)).alias("root"), F.coalesce("depth", F.lit(-1)).alias("depth"),
                       F.coalesce("path", F.array().cast("array<int>")).alias("path"),
                       (zero("n") + zero("m") + F.when(F.col("cycle") == 1, 0).otherwise(F.col("weight") - 1)).cast("bigint").alias("total"), "cycle", "scc")


def descendant_pairs(edges: DataFrame) -> DataFrame:
    """All pairs (a, d) where d can be reached from a, by squaring: logarithmically many rounds
    in the longest path. The result itself is what grows; nothing is collected."""
    pairs = materialize(edges.select(F.col("p").alias("a"), F.col("c").alias("d")).distinct(), "pairs")
    n = pairs.count()
    while True:
        left, right = pairs.select("a", F.col("d").alias("m")), pairs.select(F.col("a").alias("m"), "d")
        wider = materialize(pairs.unionByName(left.join(right, "m").select("a", "d")).distinct(), "pairs")
        more = wider.count()
        release(pairs)
        if more == n:
            return wider
        pairs, n = wider, more


def hierarchy(nodes: DataFrame, edges: DataFrame, local_edges: int = LOCAL_EDGES, paths: bool = True) -> DataFrame:
    """Per node: id, root, depth, n_descendants, in_cycle, and with ``paths`` path (ids from the
    root). ``nodes``: id; ``edges``: p, c; both distinct."""
    records, left, own, n_left = contract(nodes, edges, local_edges, paths)
    core = _finish(left, own, paths) if n_left <= local_edges else _core(left, own)
    columns = ["id", "root", "depth", *(["path"] if paths else []), "total", "cycle", "scc"]
    lone = own.where("root").join(_ends(left), "id", "left_anti").select(
        "id", F.col("id").alias("root"), F.lit(0).alias("depth"), F.array("id").alias("path"), F.col("raked").alias("total"), F.lit(0).alias("cycle"), F.col("id").alias("scc"))
    state = materialize(core.select(*columns).unionByName(lone.select(*columns)), "hier-core")
    for i, (gone, splices) in enumerate(reversed(records)):
        state = state.unionByName(materialize(_reverse(gone, splices, state, paths), f"hier-back-{i}"))
    return state.select("id", "root", "depth", *(["path"] if paths else []), (F.col("total") - F.col("cycle")).cast("int").alias("n_descendants"), F.col("cycle").alias("in_cycle"))


def descendants(nodes: DataFrame, edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """All pairs (a, d) of a node and another node below it, by reversing the contraction: what
    leads to a removed node is what leads to its only parent, that parent and the nodes hidden
    between them. So every pair is made once; only nodes spliced out of a cycle are deduplicated."""
    records, left, _, n_left = contract(nodes, edges, local_edges, True)
    if n_left <= local_edges:
        def lead(batches):
            links = [(p, c, h) for b in batches for p, c, h in zip(*(b.column(i).to_pylist() for i in range(3)))]
            for v, led in local_ancestors(links):
                for at in range(0, len(led), 50_000):
                    part = led[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([v] * len(part), pa.int32())], names=["a", "d"])

        core = left.select("p", "c", "hidden").coalesce(1).mapInArrow(lead, "a int, d int")
    else:
        closed = descendant_pairs(left.select("p", "c").distinct())
        inside = left.select("c", F.explode("hidden").alias("a"))
        through = inside.select("a", F.col("c").alias("d")).unionByName(inside.join(closed.withColumnRenamed("a", "c"), "c").select("a", "d"))
        core = closed.unionByName(through).distinct()
    # Every node leads to itself here; such pairs are left out at the end.
    itself = lambda df, x: df.select(F.col(x).alias("a"), F.col(x).alias("d"))
    roots = nodes.select("id")
    for gone, _ in records:
        roots = roots.join(gone.select(F.col("v").alias("id")), "id", "left_anti")
    pairs = materialize(core.where("a <> d").unionByName(itself(roots, "id")), "pairs-core")
    for i, (gone, splices) in enumerate(reversed(records)):
        above = gone.select("kind", "v", F.col("p").alias("d"), "hidden")
        via = above.join(pairs, "d").select("kind", "a", F.col("v").alias("d"))
        between = above.select("kind", F.explode("hidden").alias("a"), F.col("v").alias("d")).unionByName(above.select("kind", F.col("v").alias("a"), F.col("v").alias("d")))
        new = via.unionByName(between)
        out = new.where(F.col("kind") == _RAKE).select("a", "d")
        if splices:
            out = out.unionByName(new.where(F.col("kind") == _SPLICE).select("a", "d").distinct())
        pairs = pairs.unionByName(materialize(out, f"pairs-back-{i}"))
    return pairs.where("a <> d")
