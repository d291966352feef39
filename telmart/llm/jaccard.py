"""Documents linked by the Jaccard similarity of their word shingles.

A document's different shingles are hashed into groups; the counts of its
groups are a point. Two points overlap by at most the sum of the smaller count
of each group, and a box of points by at most the sum with the box's largest
counts, so an R-tree over points finds all pairs that can be similar enough;
these are verified on the shingles themselves. Nothing is estimated: no link is
lost.

To find each other without comparing all with all, documents are first dealt
out by their rarest shingles. Two linked sets share at least one of the first
n - ceil(n t / 100) + 1 shingles of each, n its size and t the similarity in
percent, in any order that is the same for all. The order is by an estimate of
how many documents have a shingle, so that passages which many documents share
bring together only documents that hold little else. The estimate counts
shingles in a fixed number of cells; it decides how much work there is, not what
is found. Of the shingles that two sets share, the first has none before it, so
they share at most what each has from there on: with p shingles before it a set
of n can be linked by it to sets of (n - p) (100 + t) / t - n shingles at most.
Two documents that allow each other's size at a shingle are neighbours. Of the
neighbours at one shingle, however many, a spanning forest is made, which has
fewer edges than documents. Chains of neighbours make neighbourhoods, each of
which has an R-tree, or one for each block of it if it is large.

The more documents there are, the more of them share a rare shingle by chance,
until chains of these join a good part of the table. So the documents of
neighbourhoods of several blocks are taken apart again: at each key neighbours
are compared by signatures, group counts whose number follows the set's size,
and only those that these allow to be linked make new neighbourhoods. Where
there still are several blocks, every two of them meet, but only as many at a
time as have about the bytes of all neighbourhoods.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telmart.llm.components import components
from telmart.llm.packing import pack, smallest, steps, unpack
from telmart.llm.shared import binary, flat, numbered, slices, text_of, unused, written
from telmart.llm.shingles import distinct, mix, shingles, words
from telmart.operators.bloom import key_filter, may_match

GROUPS = 256
FANOUT = 16
# Shingles and group counts in one block of a neighbourhood, or eighths of its texts' bytes.
BLOCK_SHINGLES = 1 << 20
KEYS_AT_ONCE = 1 << 22
BLOCKS_PER_PARTITION = 4
# Groups of signatures that are compared at a time, and bytes of the keys that are settled at a time.
PAIR_GROUPS = 1 << 22
KEY_BYTES = 1 << 24
# Sets of a key that are compared with its others.
ROUNDS = 1024
# Cells of shingles, whose frequencies all tasks hold: a byte each.
CELLS = 1 << 24
CELL_SHIFT = np.uint64(40)
GROUP_SHIFT = np.uint64(56)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words, linked from ``percent`` on."""

    words: int = 4
    percent: int = 85

    def linked(self, both, either):
        return 100 * both >= self.percent * either


def rare_keys(
    values: np.ndarray, before: np.ndarray, rule: Rule, frequency: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each (ascending) set, rarest first, as many as it
    takes to share one with every set it is linked with, and the keys before
    each set."""
    size = np.diff(before)
    many = np.where(size > 0, size - -(-size * rule.percent // 100) + 1, 0)
    order = (frequency[values >> CELL_SHIFT].astype(np.uint64) << np.uint64(58)) | (values >> np.uint64(6))
    parts = [
        values[first:stop][np.argsort(order[first:stop], kind="stable")[:count]]
        for first, stop, count in zip(before[:-1], before[1:], many)
    ]
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum(many)])


def points(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The group counts of each set."""
    sets = len(before) - 1
    cell = np.repeat(np.arange(sets), np.diff(before)) * GROUPS + (mix(values) >> GROUP_SHIFT).astype(np.int64)
    return np.bincount(cell, minlength=sets * GROUPS).reshape(sets, GROUPS).astype(np.int32)


class CountTree:
    """An R-tree packed over points: sorted by size, in slices by the most
    varied group, FANOUT to a box, boxes again FANOUT to a box."""

    def __init__(self, counts: np.ndarray, rule: Rule):
        self.rule, self.counts = rule, counts
        size = counts.sum(axis=1)
        order = np.argsort(size, kind="stable")
        widest = int(np.argmax(counts.var(axis=0))) if len(counts) else 0
        slice_rows = FANOUT * max(1, int(np.sqrt(len(counts) / FANOUT)))
        parts = [order[i: i + slice_rows] for i in range(0, len(order), slice_rows)]
        self.order = np.concatenate([p[np.argsort(counts[p, widest], kind="stable")] for p in parts]) if parts else order
        self.levels = [(counts[self.order], size[self.order], size[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            high, least, most = self.levels[-1]
            first = np.arange(0, len(high), FANOUT)
            self.levels.append((
                np.maximum.reduceat(high, first, axis=0), np.minimum.reduceat(least, first), np.maximum.reduceat(most, first),
            ))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, bound) of all pairs that may be linked."""
        t = self.rule.percent
        size = queries.sum(axis=1).astype(np.int64)
        top = len(self.levels) - 1
        out = [(np.zeros(0, np.int64),) * 3]
        for start in range(0, len(queries), 512):
            query = np.arange(start, min(start + 512, len(queries)))
            node = np.tile(np.arange(len(self.levels[top][0])), len(query))
            query = np.repeat(query, len(self.levels[top][0]))
            for level in range(top, -1, -1):
                high, least, most = self.levels[level]
                fits = (100 * most[node] >= t * size[query]) & (t * least[node] <= 100 * size[query])
                query, node = query[fits], node[fits]
                bound = np.concatenate([np.zeros(0, np.int64), *[
                    np.minimum(queries[query[i: i + 16384]], high[node[i: i + 16384]]).sum(axis=1)
                    for i in range(0, len(query), 16384)
                ]])
                keep = (100 + t) * bound >= t * (size[query] + least[node])
                query, node, bound = query[keep], node[keep], bound[keep]
                if level:
                    child = node[:, None] * FANOUT + np.arange(FANOUT)
                    real = child < len(self.levels[level - 1][0])
                    query, node = np.repeat(query, FANOUT)[real.ravel()], child[real]
            out.append((query, self.order[node], bound))
        return tuple(np.concatenate(x) for x in zip(*out))


def similar(left: list[np.ndarray], right: list[np.ndarray] | None, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """All links among sets, or between two lists of sets: every pair that
    passes the bound is verified."""
    def laid(sets):
        return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])

    within = right is None
    values, before = laid(left if within else [*left, *right])
    shift = 0 if within else len(left)
    counts = points(values, before)
    a, b, _ = CountTree(counts[shift:], rule).search(counts[: len(left)])
    if within:
        a, b = a[a < b], b[a < b]
    b = b + shift
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    different, name = np.unique(values, return_inverse=True)
    size, has = np.diff(before), np.zeros(len(different), bool)
    linked = np.zeros(len(a), bool)
    edges = np.searchsorted(a, np.arange(len(left) + 1))
    for i in np.flatnonzero(np.diff(edges)):
        own = name[before[i]: before[i + 1]]
        has[own] = True
        for first in range(edges[i], edges[i + 1], 4096):
            at = slice(first, min(first + 4096, edges[i + 1]))
            many = size[b[at]]
            stop = np.cumsum(many)
            place = np.repeat(before[b[at]] - (stop - many), many) + np.arange(stop[-1])
            both = np.add.reduceat(has[name[place]].astype(np.int64), stop - many)
            linked[at] = rule.linked(both, size[i] + many - both)
        has[own] = False
    return a[linked], b[linked] - shift


def connected(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The smallest number that links lead to, for each of ``count``."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _sets(piece: pa.RecordBatch, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    _, _, hashes, bounds = words(*flat(piece.column("text")))
    return distinct(*shingles(hashes, bounds, rule.words))


def _frequencies(texts: DataFrame, rule: Rule, blocks: int) -> np.ndarray:
    """For each cell of shingles the rounded logarithm of how many documents
    have one of them, one byte a cell. Cells that occur once among a task's
    documents are not counted: nearly all do."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for piece in slices(batch, "text"):
                cells += np.bincount((_sets(piece, rule)[0] >> CELL_SHIFT).astype(np.int64), minlength=CELLS).astype(np.uint32)
        found = np.flatnonzero(cells > 1)
        block = found * blocks // CELLS
        edges = np.searchsorted(block, np.arange(blocks + 1))
        names = [b for b in range(blocks) if edges[b + 1] > edges[b]]
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(names, pa.int32()),
            "payload": pa.array([
                pack(steps(found[edges[b]: edges[b + 1]]), smallest(cells[found[edges[b]: edges[b + 1]]])) for b in names
            ], pa.binary()),
        })

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cell, number = unpack(payload)
                own = total.setdefault(block, np.zeros(-(-CELLS // blocks) + 1, np.int64))
                own[np.cumsum(cell) - -(-block * CELLS // blocks)] += number
        for block, own in total.items():
            cell = np.flatnonzero(own)
            level = np.log2(1 + own[cell]).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({
                "payload": pa.array([pack(cell + -(-block * CELLS // blocks), level)], pa.binary())})

    counted = texts.select("text").mapInArrow(count, "block int, payload binary")
    summed = counted.repartition("block").mapInArrow(add, "payload binary")
    out = np.zeros(CELLS, np.uint8)
    # One byte for each of a fixed number of cells comes to the driver.
    for row in summed.toLocalIterator():
        cell, level = unpack(bytes(row[0]))
        out[cell] = level
    return np.minimum(out, 63)


def _sketches(texts: DataFrame, rule: Rule, frequency) -> DataFrame:
    """Per row the size and two digests of its set, its text's bytes, and its rarest shingles,
    which of equal sets of one task only the first has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                values, before = _sets(piece, rule)
                size = np.diff(before)
                sums = [
                    np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(k)), dtype=np.uint64)])
                    for k in (3, 5)
                ]
                one, two = (x[before[1:]] - x[before[:-1]] for x in sums)
                key, bounds = rare_keys(values, before, rule, frequency.value)
                own = []
                for i, name in enumerate(zip(one.tolist(), two.tolist(), size.tolist())):
                    own.append(name not in seen)
                    seen.add(name)
                packed = binary(key, np.diff(bounds))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("row"), pa.array(size, pa.int64()),
                    pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                    pa.array(np.diff(flat(piece.column("text"))[1])),
                    pa.array([x if y and len(x) else None for x, y in zip(packed.to_pylist(), own)], pa.binary()),
                ], ["doc_id", "row", "n_shingles", "one", "two", "bytes", "keys"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, row long, n_shingles long, one long, two long, bytes long, keys binary")


def _neighbours(sketches: DataFrame, rule: Rule, blocks: int) -> DataFrame:
    """A spanning forest of the neighbours at each key: a, b."""
    def edges(key, row, size, place):
        a, b = forest(key, row, size, place, rule)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return {"a": both[0], "b": both[1]}

    return _by_keys(sketches, blocks, edges, "a long, b long").distinct()


def _by_keys(sketches: DataFrame, blocks: int, settle, schema: str) -> DataFrame:
    """What ``settle`` makes of key, row, size and place of all rows of whole
    blocks of keys."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for row, size, packed in zip(*(batch.column(x).to_pylist() for x in ("row", "n_shingles", "keys"))):
                own = np.frombuffer(packed, np.uint64)
                held.append((
                    own, np.full(len(own), row, np.int64), np.full(len(own), size, np.int64), np.arange(len(own)),
                ))
                count += len(own)
                if count > KEYS_AT_ONCE:
                    yield dealt(*(np.concatenate(x) for x in zip(*held)))
                    held, count = [], 0
        if held:
            yield dealt(*(np.concatenate(x) for x in zip(*held)))

    def dealt(key, row, size, place):
        order = np.argsort(key)
        key, row, size, place = key[order], row[order], size[order], place[order]
        block = (key >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
        edges = np.searchsorted(block, np.arange(blocks + 1, dtype=np.uint64))
        names = [b for b in range(blocks) if edges[b + 1] > edges[b]]
        packed = []
        for b in names:
            part = slice(edges[b], edges[b + 1])
            least = row[part].min()
            packed.append(pack(
                steps(key[part]), np.array([least]), smallest(row[part] - least), smallest(size[part]), smallest(place[part]),
            ))
        return pa.RecordBatch.from_pydict({"block": pa.array(names, pa.int32()), "payload": pa.array(packed, pa.binary())})

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != now:
                    yield from matched(held)
                    now, held = block, []
                held.append(unpack(payload))
        yield from matched(held)

    def matched(held):
        if not held:
            return
        key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in held])
        row = np.concatenate([x[2].astype(np.int64) + x[1][0] for x in held])
        size, place = (np.concatenate([x[i].astype(np.int64) for x in held]) for i in (3, 4))
        yield pa.RecordBatch.from_pydict(settle(key, row, size, place))

    keys = sketches.where("keys IS NOT NULL").select("row", "n_shingles", "keys")
    dealt_out = keys.mapInArrow(deal, "block int, payload binary")
    return dealt_out.repartition("block").sortWithinPartitions("block").mapInArrow(match, schema)


def forest(
    key: np.ndarray, row: np.ndarray, size: np.ndarray, place: np.ndarray, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """Edges between neighbours, by which all neighbours at one key are
    connected, fewer than rows at each key. ``place`` is how many rarer keys the
    row has.
    """
    a, b = forest_places(key, size, place, rule)
    return row[a], row[b]


def allowed(size: np.ndarray, place: np.ndarray, rule: Rule) -> np.ndarray:
    """The most shingles of a set that a set can be linked with by the key at
    this place."""
    return (size - place) * (100 + rule.percent) // rule.percent - size


def forest_places(
    key: np.ndarray, size: np.ndarray, place: np.ndarray, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """The edges of ``forest`` as places in its arrays. Every row that has a
    neighbour at its key is in one.

    A row at a key allows sets of ``most`` shingles. Rows that allow their own
    size are intervals from their size to ``most``, neighbours where these
    overlap: in order of size each has an edge to the earlier one that allows
    most. Other rows are no neighbours of each other. The intervals that such a
    row is a neighbour of all hold its size, so they are connected and one edge
    does, to the one of those it allows that allows most."""
    order = np.argsort(key)
    # Keys that occur once are most; they go first.
    key = key[order]
    shared = np.zeros(len(key), bool)
    shared[1:] = key[1:] == key[:-1]
    shared[:-1] |= shared[1:]
    order = order[shared]
    if not len(order):
        return order, order
    key, size, place = key[shared], size[order], place[order]
    by_size = np.lexsort((size, key))
    key, size, place, order = key[by_size], size[by_size], place[by_size], order[by_size]
    most = allowed(size, place, rule)
    span = most >= size
    # One ascending number for key and size, and for key and the most so far.
    run = np.cumsum(np.append(False, key[1:] != key[:-1])) * (max(int(size.max()), int(most.max())) + 1)
    so_far = np.maximum.accumulate(run + np.where(span, most, 0))
    widest = np.maximum.accumulate(np.where(np.append(True, so_far[1:] != so_far[:-1]), np.arange(len(key)), 0))
    before = np.where(span, np.arange(len(key)), np.searchsorted(run + size, run + most, "right")) - 1
    at = np.flatnonzero(before >= 0)
    other = widest[before[at]]
    near = (run[other] == run[at]) & span[other] & (size[at] <= most[other]) & (size[other] <= most[at])
    return order[at[near]], order[other[near]]


def signatures(values: np.ndarray, before: np.ndarray) -> list[bytes]:
    """The group counts of each set as half bytes, of two to four shingles a
    group, so that the bound that they give is as sharp for long texts. Counts
    over 15 are stored as 15."""
    out = []
    for first, stop in zip(before[:-1], before[1:]):
        level = _level(stop - first)
        counts = np.minimum(np.bincount(
            (mix(values[first:stop]) >> np.uint64(64 - level)).astype(np.int64), minlength=1 << level), 15).astype(np.uint8)
        out.append((counts[::2] | counts[1::2] << 4).tobytes())
    return out


def _level(size) -> int:
    """The logarithm of the number of groups in the signature of a set."""
    return max(int(size).bit_length() - 2, 3)


class Signatures:
    """The signatures of sets, for bounds of what two of them share."""

    def __init__(self, packed: list[bytes], size: np.ndarray):
        self.level = np.array([(2 * len(x)).bit_length() - 1 for x in packed], np.int64)
        self.size, self.at = size, np.zeros(len(packed), np.int64)
        self.rows, self.beyond = {}, np.zeros(len(packed), np.int64)
        for level in np.unique(self.level):
            own = np.flatnonzero(self.level == level)
            self.at[own] = np.arange(len(own))
            self.rows[level] = np.frombuffer(b"".join([packed[i] for i in own]), np.uint8).reshape(len(own), -1)
            # What is not in the counts, as these end at 15.
            step = max(1, PAIR_GROUPS >> int(level))
            for part in (own[i: i + step] for i in range(0, len(own), step)):
                self.beyond[part] = size[part] - self._counts(level, self.at[part], level).sum(axis=1, dtype=np.int64)

    def _counts(self, level: int, at: np.ndarray, groups: int) -> np.ndarray:
        packed = self.rows[level][at]
        counts = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(at), -1)
        return counts if groups == level else counts.reshape(len(at), 1 << groups, -1).sum(axis=2, dtype=np.uint16)

    def linked(self, a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
        """Whether the sets a and b may be linked: none that are fail."""
        out = np.zeros(len(a), bool)
        kind = self.level[a] << 8 | self.level[b]
        for both in np.unique(kind):
            pairs, one, two = np.flatnonzero(kind == both), int(both) >> 8, int(both) & 255
            groups, step = min(one, two), max(1, PAIR_GROUPS >> max(one, two))
            for i in (pairs[k: k + step] for k in range(0, len(pairs), step)):
                x, y = self._counts(one, self.at[a[i]], groups), self._counts(two, self.at[b[i]], groups)
                bound = np.minimum(x, y).sum(axis=1, dtype=np.int64) + self.beyond[a[i]] + self.beyond[b[i]]
                out[i] = (100 + rule.percent) * bound >= rule.percent * (self.size[a[i]] + self.size[b[i]])
        return out


def sharp_forest(
    key: np.ndarray, size: np.ndarray, place: np.ndarray, sets: Signatures, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """As ``forest_places``, among neighbours whose signatures allow a link
    too. At every key a set is compared with all that are not reached yet, sets
    that were reached first, ROUNDS times; where this leaves some, the edges of
    ``forest`` are added."""
    order = np.argsort(key, kind="stable")
    group = np.zeros(len(key), np.int64)
    group[order] = np.cumsum(np.append(False, key[order][1:] != key[order][:-1])) if len(key) else 0
    most = allowed(size, place, rule)
    rest, reached = order, order[:0]
    out = [(order[:0], order[:0])]
    for _ in range(ROUNDS):
        # A group's next set, or its first one that is not reached.
        both = np.concatenate([reached, rest])
        groups, first = np.unique(group[both], return_index=True)
        pivot = both[first]
        taken = np.zeros(len(key), bool)
        taken[pivot] = True
        rest, reached = rest[~taken[rest]], reached[~taken[reached]]
        near = pivot[np.searchsorted(groups, group[rest])]
        fit = (size[rest] <= most[near]) & (size[near] <= most[rest])
        fit[fit] = sets.linked(near[fit], rest[fit], rule)
        out.append((near[fit], rest[fit]))
        reached, rest = np.concatenate([reached, rest[fit]]), rest[~fit]
        open_groups = np.zeros(len(key), bool)
        open_groups[group[rest]] = True
        reached = reached[open_groups[group[reached]]]
        if not len(rest):
            break
    else:
        left = np.flatnonzero(open_groups[group])
        a, b = forest_places(key[left], size[left], place[left], rule)
        out.append((left[a], left[b]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sharp_neighbours(sketches: DataFrame, texts: DataFrame, nodes: DataFrame, rule: Rule, blocks: int) -> DataFrame:
    """As ``_neighbours`` for the sketches (row, n_shingles, keys), whose rows
    are ``nodes``, by sharp_forest: a, b. Signatures go only to keys at which a
    set has neighbours."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(signatures(*_sets(piece, rule)), pa.binary())], ["row", "signature"])

    def postings(key, row, size, place):
        at = np.unique(np.concatenate(forest_places(key, size, place, rule)))
        return {"key": key[at].view(np.int64), "row": row[at], "size": size[at], "place": place[at]}

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole keys, until their signatures fill a block.
        held, weight, last = [], 0, None
        for batch in batches:
            keys = batch.column("key").to_numpy()
            bounds = flat(batch.column("signature"))[1] + 64 * np.arange(batch.num_rows + 1)
            start = 0
            for i in np.flatnonzero(np.append(True, keys[1:] != keys[:-1])):
                if keys[i] != last and weight + bounds[i] - bounds[start] > KEY_BYTES:
                    yield from connected_by(held + [batch.slice(start, i - start)])
                    held, weight, start = [], 0, i
                last = keys[i]
            held.append(batch.slice(start))
            weight += bounds[-1] - bounds[start]
        yield from connected_by(held)

    def connected_by(held):
        held = [x for x in held if x.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        key, row, size, place = (whole.column(x).to_numpy() for x in ("key", "row", "size", "place"))
        packed = [x for part in whole.column("signature").chunks for x in part.to_pylist()]
        a, b = sharp_forest(key, size, place, Signatures(packed, size), rule)
        both = np.unique(np.stack([np.minimum(row[a], row[b]), np.maximum(row[a], row[b])]), axis=1)
        yield pa.RecordBatch.from_pydict({"a": both[0], "b": both[1]})

    signed = may_match(texts.select("row", "text"), "row", key_filter(nodes, "row")).mapInArrow(
        sign, "row long, signature binary")
    shared = _by_keys(sketches, blocks, postings, "key long, row long, size long, place long")
    return (
        shared.join(signed, "row").repartition("key").sortWithinPartitions("key")
        .mapInArrow(connect, "a long, b long").distinct()
    )


def _links(texts: DataFrame, hoods: DataFrame, rule: Rule, pairs: bool = False) -> DataFrame:
    """The verified links within neighbourhoods (row, hood, block, blocks,
    alike): all as a, b with ``pairs``, else for each row of two blocks that has
    links there a, the row b that links lead to, and n, the documents linked."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for name, row, alike, text in zip(zip(*columns[:3]), *columns[3:], batch.column("text").to_pylist()):
                if name != now:
                    yield from settle(held)
                    now, held = name, []
                held.append((row, text, alike))
        yield from settle(held)

    def sets(held):
        batch = pa.RecordBatch.from_pydict({"text": pa.array([x[1] for x in held], pa.large_string())})
        found = (_sets(piece, rule) for piece in slices(batch, "text"))
        return [x for values, before in found for x in np.split(values, before[1:-1])]

    def settle(held):
        if len(held) < 2:
            return
        # Of two blocks that meet, each row says which one it is from.
        left = [x for x in held if x[0] >= 0]
        right = [x for x in held if x[0] < 0] or None
        if not left:
            return
        a, b = similar(sets(left), None if right is None else sets(right), rule)
        if not len(a):
            return
        both = left + (right or [])
        rows = np.array([x[0] if x[0] >= 0 else -1 - x[0] for x in both])
        alike = np.array([x[2] for x in both])
        b = b if right is None else b + len(left)
        if pairs:
            yield pa.RecordBatch.from_pydict({"a": rows[a], "b": rows[b], "n": alike[a] * alike[b]})
            return
        number = np.zeros(len(both), np.int64)
        np.add.at(number, a, alike[b])
        np.add.at(number, b, alike[a])
        linked = np.flatnonzero(number)
        yield pa.RecordBatch.from_pydict({
            "a": rows[linked], "b": rows[connected(a, b, len(both))[linked]], "n": number[linked]})

    def found(meeting):
        return (
            meeting.repartition("hood", "low", "high").sortWithinPartitions("hood", "low", "high", "row")
            .mapInArrow(search, "a long, b long, n long")
        )

    # Only the neighbourhoods' own texts are shuffled, and dealt out in the same
    # way however many they are. Texts take less room than their shingles.
    own = may_match(texts.select("row", "text"), "row", key_filter(hoods, "row"))
    placed = own.join(hoods.hint("merge"), "row")
    waves = _waves(hoods)
    if not waves:
        return found(_meeting(placed))
    # A text is shuffled once for each block of its neighbourhood, so the
    # meetings of many blocks are held one part after the other.
    one = written(found(_meeting(placed.where("blocks = 1"))), "jaccard-links-small")
    many = written(placed.where("blocks > 1"), "jaccard-texts", compression="zstd")
    return reduce(DataFrame.unionByName, [one, *[
        written(found(_meeting(many, waves, wave)), "jaccard-links-large") for wave in range(waves)
    ]])


def _waves(hoods: DataFrame) -> int:
    """How many parts the meetings of neighbourhoods of several blocks are held
    in, so that in each about as many bytes meet as all neighbourhoods have."""
    total, copied = hoods.agg(
        F.sum("bytes"), F.sum(F.when(F.col("blocks") > 1, F.col("bytes") * F.col("blocks")).otherwise(0))
    ).first()
    return -(-copied // max(total, 1)) if copied else 0


def _meeting(placed: DataFrame, waves: int = 1, wave: int = 0) -> DataFrame:
    """Every two blocks of a neighbourhood meet in one task; the row of the
    second one is marked by its sign."""
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    if waves > 1:
        others = F.filter(others, lambda other: F.pmod(
            F.xxhash64("hood", F.least("block", other), F.greatest("block", other)), F.lit(waves)) == wave)
    return placed.withColumn("other", F.explode(others)).select(
        "hood", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        F.when(F.col("block") <= F.col("other"), F.col("row")).otherwise(-1 - F.col("row")).alias("row"), "alike", "text",
    )


def linked_documents(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links lead
    to, its own included) and first (whether it is the document of that
    identifier, one row of each component) and n_links (the other rows that
    it is linked with, those of an equal set included) of every document.

    Words are runs of bytes other than white space, A-Z in lower case; a text
    of fewer words than a shingle is one shingle. A text without words, empty
    and null ones included, has none and is linked with nothing. Equal sets are
    found first, by their digests, and take part once. Repeated rows are linked
    with each other; a null doc_id is no smallest one, and a component that has
    no other has a null component_id. Other columns are ignored.
    """
    return _linked(numbered(documents), rule)[0].drop("row")


def links(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every link between different sets: a_id, b_id, the smallest identifiers
    of both, and n, the pairs of documents that it stands for."""
    _, texts, placed, classes = _linked(numbered(documents), rule)
    names = classes.select("node", F.col("leader.doc_id").alias("id"))
    return (
        _links(texts, placed, rule, pairs=True)
        .join(names.toDF("a", "a_id"), "a").join(names.toDF("b", "b_id"), "b").select("a_id", "b_id", "n")
    )


def without_near_copies(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One document of each component, that of the smallest identifier, with
    all its columns. Documents without words all stay."""
    # Written with their numbers: another scan may be split in another way.
    name = unused(documents, "row")
    rows = written(documents.withColumn(name, F.monotonically_increasing_id()), "jaccard-rows", compression="zstd")
    texts = rows.select("doc_id", text_of().alias("text"), F.col(name).alias("row"))
    kept = _linked(texts, rule)[0].where("first").select(F.col("row").alias(name))
    return rows.join(kept, name, "left_semi").select(*documents.columns)


def _placed(near: DataFrame, members: DataFrame) -> DataFrame:
    """The neighbourhoods of the edges, and their rows' blocks."""
    hoods = components(near).withColumnRenamed("label", "hood").withColumnRenamed("node", "row")
    sized = hoods.join(members.select("row", "n_shingles", "bytes", "alike"), "row")
    weight = F.greatest(F.col("n_shingles") + GROUPS, F.col("bytes") / 8)
    parts = sized.groupBy("hood").agg((F.sum(weight) / BLOCK_SHINGLES + 1).cast("int").alias("blocks"))
    return written(sized.join(parts, "hood").select(
        "row", "hood", F.pmod(F.xxhash64("row"), F.col("blocks").cast("long")).cast("int").alias("block"),
        "blocks", "alike", "bytes",
    ), "jaccard-hoods")


def _linked(texts: DataFrame, rule: Rule) -> tuple[DataFrame, ...]:
    blocks = BLOCKS_PER_PARTITION * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequency = texts.sparkSession.sparkContext.broadcast(_frequencies(texts, rule, blocks))
    sketches = written(_sketches(texts, rule, frequency), "jaccard-sets")
    classes = written(
        sketches.where("n_shingles > 0").groupBy("one", "two", "n_shingles").agg(
            F.min("row").alias("node"), F.count("*").alias("alike"),
            # The smallest identifier, null last, and its first row.
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("leader"),
        ), "jaccard-classes",
    )
    members = written(
        sketches.drop("keys").join(classes, ["one", "two", "n_shingles"], "left")
        .select("row", "doc_id", "n_shingles", "bytes", "node", "leader", "alike"), "jaccard-members",
    )
    node_of = members.where("node IS NOT NULL").select("row", "node")
    near = (
        _neighbours(sketches, rule, blocks)
        .join(node_of.select(F.col("row").alias("a"), F.col("node").alias("x")), "a")
        .join(node_of.select(F.col("row").alias("b"), F.col("node").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    placed = _placed(near, members)
    large = placed.where("blocks > 1")
    if not large.isEmpty():
        # Chance brings many documents together that share next to nothing.
        rows = written(node_of.join(large.select(F.col("row").alias("node")), "node"), "jaccard-large")
        chosen = may_match(
            sketches.where("keys IS NOT NULL").select("row", "n_shingles", "keys"), "row", key_filter(rows, "row")
        ).join(rows, "row").dropDuplicates(["node"]).select(F.col("node").alias("row"), "n_shingles", "keys")
        near = _sharp_neighbours(chosen, texts, large.select("row"), rule, blocks)
        placed = placed.where("blocks = 1").unionByName(_placed(near, members))
    near = written(_links(texts, placed, rule), "jaccard-links")
    number = near.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    found = components(near)
    leaders = found.join(classes.select("node", "leader"), "node").groupBy("label").agg(F.min("leader").alias("head"))
    # Written, so that the join deals both sides out and can split a frequent set.
    names = written(found.join(leaders, "label").join(number, "node").select("node", "head", "n"), "jaccard-components")
    lone = F.col("n_shingles") == 0
    rows = members.join(names, "node", "left").withColumn("head", F.coalesce("head", "leader")).select(
        "doc_id", "n_shingles",
        F.when(lone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (lone | (F.col("row") == F.col("head.row"))).alias("first"),
        F.when(lone, 0).otherwise(F.coalesce("n", F.lit(0)) + F.col("alike") - 1).cast("long").alias("n_links"), "row",
    )
    return rows, texts, placed, classes
