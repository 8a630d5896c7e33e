"""Problem 1: mapping free-entered values to a canonical list.

Method: a trie of the reference entries, alias paths included, is searched with a Levenshtein
automaton (transpositions count as one slip); all entries within a length-dependent distance
are returned, the closest win. The automaton is compiled: its states are the bands of the
alignment matrix, its input says which letters near the diagonal equal the trie's letter, so one
table per distance serves every word. The trie is walked level by level for many words at once.

Scale: the trie is compiled once and broadcast after a check of its size (``MOST_ENTRIES``).
A longer reference list stays on the executors: its blocks meet blocks of the distinct values in
a cogroup, both sides bounded, and the best of each value over all blocks is kept by a hash
aggregation. Results do not depend on the block size. Values are mapped where they are read; each
distinct value of a batch is searched once.

Cases: null, empty and blank texts give no value, so no row; a value of general words or numbers
only names nothing and gives 'no name'; a value without an entry gives 'unmatched'; ties between
entries at the same distance are all returned; numbers in a value and in an entry must agree where
both have some; a text may be long and hold many values; an empty reference list leaves every
value unmatched; rows delivered twice and other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from talespan.llm.captiontext import strip_accents
from talespan.runtime import materialize, spread

#: Entries (names and aliases) per block of the reference list, and values per block of values.
MOST_ENTRIES = 200_000
UNMATCHED, NO_NAME = "unmatched", "no name"

# General words that say what kind of thing a name is, or that it is a keyword.
GENERAL = frozenset("""
kamp kampen kmp kp kz camp camps lager concentratiekamp doorgangskamp werkkamp durchgangslager arbeitslager strafkamp interneringskamp
dorp stad stadje plaats plaatsnaam gem gemeente gemeinde ort dorf stadt town village city place location locatie
te in bij nabij near bei omgeving omg eo regio streek buurt region the het de den der das die een a an
trefwoord trefwoorden keyword keywords tw thema theme topic onderwerp subject term begrip over about
nl nederland netherlands nld de d duitsland
""".split()) - {"d"}
_PREFIX = re.compile(r"^\s*(?:trefwoorden|trefwoord|keywords?|tw|plaats\s*/\s*onderwerp|onderwerp|plaats|thema|stichwort|schlagwort)\s*(?:[:–—=]|-\s)\s*", re.I)
_SPLIT = re.compile(r"[;|\n\r+/,•·]|\s&\s|\t")
_DOTTED = re.compile(r"\b(?:[a-z]\.){2,}(?!\w)|\b(?:[a-z]\.)+[a-z]\b(?!\w)", re.I)
_BRACKETED = re.compile(r"[(\[]([^()\[\]]*)[)\]]")


def split_values(text: str | None) -> list[str]:
    """The single values of a typed text, prefixes such as "keyword:" gone."""
    if not text:
        return []
    out = []
    for line in re.split(r"[\n\r]", text):
        out += _SPLIT.split(_PREFIX.sub("", line.strip(" \t\"'#")))
    return [v for v in (x.strip(" \t\"'“”„#?!.-–") for x in out) if v]


def _tokens(value: str) -> list[str]:
    s = strip_accents(value).casefold()
    s = _DOTTED.sub(lambda m: m[0].replace(".", ""), s)
    return re.findall(r"[^\W\d_]+|\d+", s)


def squeezed(value: str, general: frozenset = GENERAL) -> tuple[list[str], frozenset]:
    """Forms of a value to search, and its numbers. Forms hold letters only: first without all
    general words, then only without those at its ends (a word break may leave a piece that looks
    like one), then with all. No form when nothing but general words and numbers is left."""
    plain = _BRACKETED.sub(lambda m: " " if all(t in general or t.isdigit() for t in _tokens(m[1])) else f" {m[1]} ", value)
    tokens = _tokens(plain)
    words = [t for t in tokens if not t.isdigit()]
    core = [w for w in words if w not in general]
    if not core:
        return [], frozenset()
    first = next(i for i, w in enumerate(words) if w not in general)
    last = next(i for i in range(len(words) - 1, -1, -1) if words[i] not in general)
    forms = ["".join(core), "".join(words[first:last + 1]), "".join(words)]
    numbers = frozenset(t.lstrip("0") or "0" for t in tokens if t.isdigit()) if len(words) < len(tokens) else frozenset()
    return list(dict.fromkeys(forms)), numbers


def slips_allowed(length: int) -> int:
    """The length-dependent distance: none up to 3 letters, one up to 5, else two."""
    return 0 if length <= 3 else 1 if length <= 5 else 2


@lru_cache(maxsize=None)
def automaton(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The Levenshtein automaton of a distance for any word: (step[state, signs] -> state,
    final[state, offset] -> distance). State 0 is dead, 1 the start.

    After i letters a state holds the alignment's cells at offsets -limit..limit from the
    diagonal, cut off beyond the limit, and the cells that a swap with the next letter would
    give. Bit b of ``signs`` tells whether the letter read equals the word's letter at position
    i - limit - 1 + b."""
    far, span, width = limit + 1, 2 * limit + 1, 2 * limit + 3
    start = (tuple(abs(o) if o >= 0 else far for o in range(-limit, limit + 1)), (far,) * span)
    dead = ((far,) * span, (far,) * span)
    number, order, step = {dead: 0, start: 1}, [dead, start], []
    at = 0
    while at < len(order):
        row, swap = order[at]
        out = []
        for signs in range(1 << width):
            new = []
            for o in range(span):
                d = row[o] + (not signs >> (o + 1) & 1)
                if o < span - 1 and row[o + 1] + 1 < d:
                    d = row[o + 1] + 1
                if o and new[o - 1] + 1 < d:
                    d = new[o - 1] + 1
                if signs >> o & 1 and swap[o] < d:
                    d = swap[o]
                new.append(min(d, far))
            state = (tuple(new), tuple(min(row[o] + 1, far) if signs >> (o + 2) & 1 else far for o in range(span)))
            if state not in number:
                number[state] = len(order)
                order.append(state)
            out.append(number[state])
        step.append(out)
        at += 1
    return np.array(step, np.int32), np.array([r for r, _ in order], np.int8)


class Lexicon:
    """Trie over squeezed names and aliases in arrays; every end holds the entries it leads to."""

    def __init__(self, entries: Iterable[tuple[str, Iterable[str | None]]], general: frozenset = GENERAL):
        self.general = general
        self.tables = {k: automaton(k) for k in (1, 2)}  # compiled here, so that workers need not
        exact: dict[str, set[tuple[str, frozenset]]] = {}
        for uri, names in entries:
            for name in names:
                forms, numbers = squeezed(name or "", general)
                if forms:
                    exact.setdefault(forms[0], set()).add((uri, numbers))
        self.exact = {f: sorted(e, key=lambda x: (x[0], sorted(x[1]))) for f, e in exact.items()}
        self.forms = sorted(self.exact)
        self.longest = max(map(len, self.forms), default=0)
        root: dict = {}
        for k, form in enumerate(self.forms):
            node = root
            for c in form:
                node = node.setdefault(c, {})
            node[""] = k
        # Nodes are numbered level by level, so the children of a node have consecutive numbers.
        nodes, letters, parents = [root], [0], [0]
        first, size, end = [], [], []
        for at, node in enumerate(nodes):  # grows while it is read
            kids = [(c, n) for c, n in node.items() if c]
            first.append(len(nodes))
            size.append(len(kids))
            end.append(node.get("", -1))
            for c, n in kids:
                nodes.append(n)
                letters.append(ord(c))
                parents.append(at)
        lengths = np.array([len(f) for f in self.forms] + [0])
        self.first, self.size, self.end, self.letter = (np.array(x, np.int32) for x in (first, size, end, letters))
        least, most = np.where(self.end >= 0, lengths[self.end], 1 << 20), np.where(self.end >= 0, lengths[self.end], -1)
        for at in range(len(nodes) - 1, 0, -1):
            p = parents[at]
            least[p], most[p] = min(least[p], least[at]), max(most[p], most[at])
        self.least, self.most = least.astype(np.int32), most.astype(np.int32)

    def search(self, words: list[str], limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All forms within ``limit`` slips of each word: (word, form, distance) numbers."""
        order = sorted((i for i, w in enumerate(words) if len(w) <= self.longest + limit), key=lambda i: len(words[i]))
        found, at, most = [], 0, 512
        while at < len(order):
            part = order[at:at + most]
            got = self._walk([words[i] for i in part], limit)
            if got is None:  # too many different letters at once
                most = max(1, most // 2)
                continue
            w, form, distance = got
            found.append((np.array(part, np.int64)[w], form, distance))
            at += len(part)
        empty = np.array([], np.int64)
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (empty, empty, empty)

    def _walk(self, words: list[str], limit: int):
        step, final = self.tables[limit] if limit in self.tables else automaton(limit)
        n, width = len(words), 2 * limit + 3
        length = np.array([len(w) for w in words], np.int32)
        deep = int(min(length.max() + limit, self.longest))
        letters = np.zeros((n, max(deep, int(length.max())) + width + limit), np.int32)  # letter j (from 1) in column j + limit
        for i, w in enumerate(words):
            letters[i, limit + 1:limit + 1 + len(w)] = np.frombuffer(w.encode("utf-32-le"), np.int32)
        known = np.unique(letters)[1:]
        if n > 1 and (len(known) + 1) * n * deep > 1 << 25:
            return None
        signs = np.zeros((len(known) + 1, n, deep), np.uint8)
        for a, c in enumerate(known, 1):
            same = (letters == c).view(np.uint8)
            for b in range(width):
                signs[a] |= same[:, b:b + deep] << np.uint8(b)
        signs = signs.ravel()
        spot = np.searchsorted(known, self.letter)
        spot = np.where((spot < len(known)) & (known[np.minimum(spot, len(known) - 1)] == self.letter), spot + 1, 0) if len(known) else np.zeros(len(self.letter), np.int64)
        base = spot.astype(np.int64) * (n * deep)
        word, node, state = np.arange(n), np.zeros(n, np.int64), np.ones(n, np.int32)
        out = []
        for depth in range(1, deep + 1):
            kids = self.size[node]
            rep = np.repeat(np.arange(len(node)), kids)
            child = np.arange(len(rep)) + np.repeat(self.first[node] - np.cumsum(kids) + kids, kids)
            w = word[rep]
            fits = np.flatnonzero((self.most[child] >= length[w] - limit) & (self.least[child] <= length[w] + limit))
            rep, child, w = rep[fits], child[fits], w[fits]
            new = step[state[rep], signs[base[child] + w * deep + (depth - 1)]]
            live = np.flatnonzero(new)
            word, node, state = w[live], child[live], new[live]
            off = length[word] - depth
            ends = np.flatnonzero((self.end[node] >= 0) & (np.abs(off) <= limit))
            d = final[state[ends], off[ends] + limit]
            hit = np.flatnonzero(d <= limit)
            if len(hit):
                out.append((word[ends[hit]], self.end[node[ends[hit]]], d[hit]))
            if not len(node):
                break
        empty = np.array([], np.int64)
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (empty, empty, empty)


#: Rank of a value that names nothing, and of one without an entry; found ranks are from 0.
_NOTHING, _LONE = -2, -1


class Mapper:
    """Maps values to their closest entries; remembers values it has seen (bounded)."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, list[str]]] = {}

    def best(self, values: Iterable[str]) -> dict[str, tuple[int, list[str]]]:
        """value -> (rank, uris) of the closest entries. The rank orders by distance, then by
        form, then by whether the numbers are the same; it is distance * 16 and more."""
        if len(self.known) > 200_000:
            self.known.clear()
        known, lexicon, open_ = self.known, self.lexicon, {}
        for value in values:
            if value in known:
                continue
            forms, numbers = squeezed(value, lexicon.general)
            known[value] = (_LONE if forms else _NOTHING, [])
            got = [(k, 0, e) for k, f in enumerate(forms) for e in lexicon.exact.get(f, ())]
            if not self._settle(value, numbers, got) and forms:
                open_[value] = forms, numbers
        near: dict[str, list[tuple[int, int]]] = {}
        for limit in (1, 2):
            words = list({f for forms, _ in open_.values() for f in forms if slips_allowed(len(f)) == limit})
            if words:
                for w, form, d in zip(*(x.tolist() for x in lexicon.search(words, limit))):
                    near.setdefault(words[w], []).append((form, d))
        for value, (forms, numbers) in open_.items():
            self._settle(value, numbers, [(k, d, e) for k, f in enumerate(forms) for form, d in near.get(f, ()) for e in lexicon.exact[lexicon.forms[form]]])
        return known

    def _settle(self, value: str, numbers: frozenset, candidates) -> bool:
        ranked = [(d * 16 + k * 2 + (own != numbers), uri) for k, d, (uri, own) in candidates if not (own and numbers) or own <= numbers]
        if ranked:
            least = min(r for r, _ in ranked)
            self.known[value] = least, sorted({u for r, u in ranked if r == least})
        return bool(ranked)


def _each(batches, n: int):
    """(index of the row, value) lists per batch whose text column follows n id columns."""
    for batch in batches:
        take, values = [], []
        for i, text in enumerate(batch.column(n).to_pylist()):
            got = split_values(text)
            take += [i] * len(got)
            values += got
        yield batch, take, values


def _small(df: DataFrame, id_cols: list[str], text_col: str, lexicon: Lexicon, schema: StructType) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    n = len(id_cols)

    def run(batches):
        mapper = Mapper(shared.value)
        for batch, rows, values in _each(batches, n):
            best = mapper.best(dict.fromkeys(values))
            take, value, uri, distance = [], [], [], []
            for i, v in zip(rows, values):
                rank, uris = best[v]
                for u in uris or [NO_NAME if rank == _NOTHING else UNMATCHED]:
                    take.append(i)
                    value.append(v)
                    uri.append(u)
                    distance.append(rank if rank < 0 else rank // 16)
            index = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(k).take(index) for k in range(n)] + [pa.array(value, pa.string()), pa.array(uri, pa.string()), pa.array(distance, pa.int32())],
                                             names=[*id_cols, "value", "uri", "distance"])

    return df.mapInArrow(run, schema)


def _large(df: DataFrame, id_cols: list[str], text_col: str, ref: DataFrame, n_entries: int, block: int, schema: StructType, general: frozenset) -> DataFrame:
    """Blocks of distinct values against blocks of the reference list, both on the executors."""
    n = len(id_cols)

    def split(batches):
        for batch, rows, values in _each(batches, n):
            index = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(k).take(index) for k in range(n)] + [pa.array(values, pa.string())], names=[*id_cols, "value"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        values = left.column("value").to_pylist()
        best = Mapper(Lexicon(zip(right.column("uri").to_pylist(), ([x] for x in right.column("name").to_pylist())), general)).best(values) if values else {}
        rows = [(v, u, best[v][0]) for v in values for u in best[v][1] or [None]]
        return pa.table({"value": pa.array([r[0] for r in rows], pa.string()), "uri": pa.array([r[1] for r in rows], pa.string()), "rank": pa.array([r[2] for r in rows], pa.int32())})

    typed = materialize(df.mapInArrow(split, StructType([*schema.fields[:n], StructField("value", StringType())])), "typed")
    distinct = materialize(typed.select("value").distinct(), "typed-values")
    cuts, blocks = max(1, -(-distinct.count() // block)), max(1, -(-n_entries // block))
    numbers = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = distinct.select("value", F.pmod(F.xxhash64("value"), F.lit(cuts)).cast("int").alias("cut"), numbers(blocks).alias("block"))
    right = ref.select("uri", F.explode("names").alias("name")).select(
        "uri", "name", F.pmod(F.xxhash64("uri", "name"), F.lit(blocks)).cast("int").alias("block"), numbers(cuts).alias("cut"))
    met = left.groupBy("cut", "block").cogroup(right.groupBy("cut", "block")).applyInArrow(meet, "value string, uri string, rank int")
    found = F.when(F.col("rank") >= 0, F.col("rank"))
    # Per value and rank first, so that only the uris of the best rank are gathered.
    by_rank = met.groupBy("value", "rank").agg(F.collect_set("uri").alias("uris"))
    best = by_rank.groupBy("value").agg(F.coalesce(F.min(found), F.min("rank")).alias("rank"), F.min_by("uris", found).alias("uris"))
    lone = F.when(F.col("rank") == _NOTHING, NO_NAME).otherwise(UNMATCHED)
    best = best.select("value", F.explode(F.when(F.col("rank") >= 0, F.col("uris")).otherwise(F.array(lone))).alias("uri"),
                       F.when(F.col("rank") < 0, F.col("rank")).otherwise(F.floor(F.col("rank") / 16)).cast("int").alias("distance"))
    return typed.join(best, "value").select(*id_cols, "value", "uri", "distance")


def map_values(df: DataFrame, id_cols: list[str], text_col: str, reference: DataFrame, block: int = MOST_ENTRIES, general: frozenset = GENERAL) -> DataFrame:
    """One row per value of ``text_col`` and closest entry: id_cols, value, uri, distance
    ('unmatched' and -1 without an entry, 'no name' and -2 for general words only). ``reference``:
    uri, name, alternate_names; ``general``: words that say only what kind of thing a name is."""
    ref = reference.where("uri IS NOT NULL").select("uri", F.concat(F.array("name"), F.coalesce("alternate_names", F.array().cast("array<string>"))).alias("names"))
    total = ref.agg(F.coalesce(F.sum(F.size("names")), F.lit(0))).first()[0]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = StructType([StructField(c, kinds[c]) for c in id_cols] + [StructField("value", StringType()), StructField("uri", StringType()), StructField("distance", IntegerType())])
    rows = spread(df.select(*id_cols, text_col))
    if total > block:
        return _large(rows, id_cols, text_col, ref, total, block, schema, general)
    return _small(rows, id_cols, text_col, Lexicon((tuple(r) for r in ref.collect()), general), schema)
