"""Approximate nearest neighbours by inner product: a neighbour graph built by
NN-descent and searched greedily, both as rounds of Spark joins.

Equal vectors are one node. Every node keeps a pool of the nearest nodes found
so far, at first random ones. In a round each node sends itself to the nodes at
the top of its pool (``_members``), and each node's own list meets those who
named it and those whom it names: whoever is there learns of the list's
nodes, neighbours of neighbours (``_descend``). A node is named once by each
other node at most, and names a fixed number, so no place has more than the
2 x JOINED-th part of all rows. Rounds end when few pools change.

For inner products the graph is built on vectors that an extra coordinate
brings to equal length, which makes the nearest ones by angle, distance and
inner product with any query the same. The graph works on 8-bit vectors; what
the search finds is scored again on the original ones in double precision.

A search starts at some fixed nodes and, where the query's vector is in the
index, at its own node and that node's neighbours. Each round opens the best
unopened nodes of every query's pool and scores their neighbours, until the best
ones are all open. Once few are left, the pools stay where they are and what is
found for some of them is sent to all tasks.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from telmart.llm.shared import binary, flat, release, slices, stored, written
from telmart.llm.shingles import mix
from telmart.llm.vectors import matrix, usable
from telmart.session import new_folder

# Nearest nodes that the graph keeps of each node.
DEGREE = 40
# Of these, how many take part in a round; later rounds as the last.
JOINED = (12, 20, 32, 40)
MOST_ROUNDS = 24
# A round that changes a smaller share of all pools' entries is the last one.
SETTLED = 0.1
# A search's pool, how many nodes each round opens of it (later rounds as the last:
# all that it has), and its fixed starts.
POOL = 128
OPENED = (48, POOL)
STARTS = 256
# So few unopened nodes, and what is found for them, are sent to all tasks: 15 MB
# at most with vectors of 64 dimensions, so that the last rounds shuffle no pools.
FEW = 1 << 14

STATE = "node long, kind int, vec binary, ids binary, sims binary, old binary"
UPDATE_COLUMNS = ["node", "kind", "vec", "ids", "sims", "old"]
CODE_LEVELS = 127


# 8-bit vectors

def _encode(values: np.ndarray) -> np.ndarray:
    """Rows of 8-bit numbers, each followed by the four bytes of its scale."""
    scale = np.abs(values).max(axis=1, initial=0, keepdims=True) / CODE_LEVELS
    code = np.round(values / np.where(scale > 0, scale, 1)).astype(np.int8)
    return np.hstack([code.view(np.uint8), np.ascontiguousarray(scale.astype("<f4")).view(np.uint8)])


def _decode(codes: np.ndarray) -> np.ndarray:
    scale = np.ascontiguousarray(codes[:, -4:]).view("<f4")
    return np.ascontiguousarray(codes[:, :-4]).view(np.int8) * scale


def _codes(column: pa.Array, width: int) -> np.ndarray:
    return flat(column)[0].reshape(-1, width)


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row holds."""
    data, offsets = flat(column)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def _state(node: np.ndarray, kind: int, vec: pa.Array, counts, ids, sims, old) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(node, pa.int64()), pa.array(np.full(len(node), kind, np.int32)), vec,
            binary(ids.astype("<i8"), counts), binary(sims.astype("<f4"), counts), binary(old.astype(np.uint8), counts),
        ],
        UPDATE_COLUMNS,
    )


def _best(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, old: np.ndarray, most: int):
    """Of each owner's entries the best different ones, best first; an entry
    that is there twice counts as old if one of the two is."""
    if not len(owner):
        return owner, ids, sims, old
    order = np.lexsort((-sims, ids, owner))
    owner, ids, sims, old = (x[order] for x in (owner, ids, sims, old))
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])))
    old = np.maximum.reduceat(old, first)
    owner, ids, sims = (x[first] for x in (owner, ids, sims))
    order = np.lexsort((ids, -sims, owner))
    owner, ids, sims, old = (x[order] for x in (owner, ids, sims, old))
    keep = _places(owner) < most
    return owner[keep], ids[keep], sims[keep], old[keep]


def _places(owner: np.ndarray) -> np.ndarray:
    """Each entry's place among its owner's, which stand together."""
    start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
    return np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by node, cut between nodes."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column("node").to_numpy()
        cut = int(np.searchsorted(node, node[-1]))
        if cut or (rest and rest[-1].column("node")[-1].as_py() != node[0]):
            yield pa.concat_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.concat_batches(rest)


def _merge(most: int):
    """Pools (kind 0) and what was found for them (kind 1), sorted by node and
    kind: new pools. What a node has gathered by the end of a batch goes on as
    its pool, so a node's rows are never held together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pools = merged(batch if rest is None else pa.concat_batches([rest, batch]))
            rest = pools.slice(pools.num_rows - 1)
            yield pools.slice(0, pools.num_rows - 1)
        if rest is not None:
            yield rest

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        node = batch.column("node").to_numpy()
        ids, counts = _numbers(batch.column("ids"), "<i8")
        sims, old = _numbers(batch.column("sims"), "<f4")[0], _numbers(batch.column("old"), "u1")[0]
        owner, ids, sims, old = _best(np.repeat(node, counts), ids, sims, old, most)
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        nodes = node[first]
        counts = np.searchsorted(owner, nodes, "right") - np.searchsorted(owner, nodes)
        return _state(nodes, 0, batch.column("vec").take(pa.array(first)), counts, ids, sims, old)

    return run


def _found_rows(owner, ids, sims, most: int) -> pa.RecordBatch:
    """What was found, one row for each node that it was found for."""
    owner, ids, sims, old = _best(owner, ids, sims, np.zeros(len(ids), np.uint8), most)
    nodes, counts = np.unique(owner, return_counts=True)
    return _state(nodes, 1, pa.nulls(len(nodes), pa.binary()), counts, ids, sims, old)


# The graph

MEMBER = "node long, kind int, id long, vec binary, least float, old boolean"


def _least_of(counts: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """What a node must exceed to come into each pool."""
    least = np.full(len(counts), -np.inf, np.float32)
    full = counts >= most
    least[full] = sims[np.cumsum(counts)[full] - 1]
    return least


def _own(most: int):
    """Each pool's node with what a node must exceed to come into it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims, counts = _numbers(batch.column("sims"), "<f4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("vec"), pa.array(_least_of(counts, sims, most))], ["node", "vec", "least"]
            )

    return run


def _members(joined: int, most: int):
    """Each pool's node, sent to the nodes at the pool's top."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = _numbers(batch.column("ids"), "<i8")
            sims, old = _numbers(batch.column("sims"), "<f4")[0], _numbers(batch.column("old"), "u1")[0]
            least = _least_of(counts, sims, most)
            owner = np.repeat(np.arange(len(counts)), counts)
            top = _places(owner) < joined
            owner, ids, old = owner[top], ids[top], old[top]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids), pa.array(np.ones(len(ids), np.int32)),
                    batch.column("node").take(pa.array(owner)), batch.column("vec").take(pa.array(owner)),
                    pa.array(least[owner]), pa.array(old.astype(bool)),
                ],
                ["node", "kind", "id", "vec", "least", "old"],
            )

    return run


def _opened(joined: int):
    """The pools with the entries at their top marked as old."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = _numbers(batch.column("ids"), "<i8")
            sims, old = _numbers(batch.column("sims"), "<f4")[0], _numbers(batch.column("old"), "u1")[0].copy()
            old[_places(np.repeat(np.arange(len(counts)), counts)) < joined] = 1
            yield _state(batch.column("node").to_numpy(), 0, batch.column("vec"), counts, ids, sims, old)

    return run


def _descend(width: int, most: int):
    """Rows sorted by (node, kind): a node's list (kind 0), then those who
    named it (kind 1). Gives each of them the list's nodes that are nearer
    than its pool's last one, unless both steps were taken before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, current = None, None
        lists = (np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, bool))
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            node, kind = batch.column("node").to_numpy(), batch.column("kind").to_numpy()
            # A list that goes on in the next batch waits for it.
            end = len(node)
            if end and kind[-1] == 0:
                end = int(np.searchsorted(node, node[-1]))
            rest, batch = batch.slice(end), batch.slice(0, end)
            yield from deal(batch, width, most, lists, current)
            if end:
                lists, current = carried(batch, width, lists, current)
        if rest is not None and rest.num_rows:
            yield from deal(rest, width, most, lists, current)

    def carried(batch, width, lists, current):
        node = batch.column("node").to_numpy()
        start = int(np.searchsorted(node, node[-1]))
        last = batch.slice(start)
        own = last.column("kind").to_numpy() == 0
        if not own.any():
            return (lists, current) if node[-1] == current else (no_list(), node[-1])
        return (
            last.column("id").to_numpy()[own], _decode(_codes(last.column("vec"), width)[own]),
            last.column("old").to_numpy(zero_copy_only=False)[own],
        ), node[-1]

    def no_list():
        return np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, bool)

    def deal(batch, width, most, lists, current):
        if not batch.num_rows:
            return
        node, kind, ids = (batch.column(x).to_numpy() for x in ("node", "kind", "id"))
        least, old = batch.column("least").to_numpy(), batch.column("old").to_numpy(zero_copy_only=False)
        vec = _decode(_codes(batch.column("vec"), width))
        start = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        stop = np.append(start[1:], len(node))
        listed = np.add.reduceat((kind == 0).astype(np.int64), start)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b, size in zip(start.tolist(), stop.tolist(), listed.tolist()):
            if size:
                to, to_vec, to_old = ids[a: a + size], vec[a: a + size], old[a: a + size]
            elif node[a] == current:
                to, to_vec, to_old = lists
            else:
                continue
            if not len(to):
                continue
            sims = vec[a:b] @ to_vec.T
            at, which = np.nonzero(
                (sims > least[a:b, None]) & (ids[a:b, None] != to) & ~(old[a:b, None] & to_old)
            )
            found.append((ids[a:b][at], to[which], sims[at, which]))
        if found:
            yield _found_rows(*(np.concatenate(x) for x in zip(*found)), most)

    return run


@dataclass
class Index:
    """nodes (node, one, two, vector, vec), members (node, vec_id), and the
    name of the table of lists (node, ids, vecs), in buckets by node: a search
    shuffles what it opens, not the graph."""

    nodes: DataFrame
    members: DataFrame
    lists: str
    d: int
    n: int
    folders: list[str]

    @property
    def width(self) -> int:
        return self.d + 5

    def remove(self) -> None:
        spark = self.nodes.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.lists}")
        release(spark, *self.folders)


def _keys(vector: Column) -> list[Column]:
    """Two 64-bit hashes, by which equal vectors are told."""
    return [F.xxhash64(vector).alias("one"), F.xxhash64(F.lit(12), vector).alias("two")]


def _taking_part(rows: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    found, d = usable(rows, vector_column, [F.col(id_column).cast("long").alias("vec_id")])
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    one = found.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return one.withColumn("norm", norm).where("norm > 0"), d


def _numbered(spark: SparkSession, distinct: DataFrame) -> tuple[DataFrame, str, int]:
    """The rows as a written table with numbers from 0 without gaps, whose
    folder and number of rows come too. Where each written part's numbers
    begin is known to all tasks: as many numbers as there are parts."""
    rows, folder = stored(distinct.withColumn("row", F.monotonically_increasing_id()), "ann-distinct")
    parts = rows.groupBy(F.shiftright("row", 33).alias("part")).agg(F.count("*").alias("n"), F.min("row").alias("low")).orderBy("part")
    begin, before = {}, 0
    for part in parts.collect():
        begin[part["part"]] = before - part["low"]
        before += part["n"]
    if not begin:
        return rows.withColumnRenamed("row", "node"), folder, 0
    shift = spark.createDataFrame(list(begin.items()), "part long, shift long")
    rows = rows.withColumn("part", F.shiftright("row", 33)).join(F.broadcast(shift), "part")
    return rows.withColumn("node", F.col("row") + F.col("shift")).drop("row", "part", "shift"), folder, before


def _coded(longest: float, d: int):
    """8-bit vectors with the extra coordinate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch, d).astype(np.float64)
            extra = np.sqrt(np.maximum(longest - np.square(values).sum(axis=1, keepdims=True), 0))
            codes = _encode(np.hstack([values, extra]))
            rows = [batch.column(x) for x in ("node", "one", "two", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*rows, binary(codes.reshape(-1), np.full(len(codes), codes.shape[1]))], ["node", "one", "two", "vector", "vec"]
            )

    return run


def _first_pools(n: int, size: int):
    """Pools of random nodes, at the similarity that any other one beats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            seed = mix((node[:, None].astype(np.uint64) << np.uint64(8)) + np.arange(size, dtype=np.uint64))
            ids = (seed % np.uint64(n)).astype(np.int64)
            owner, ids, sims, old = _best(
                np.repeat(np.arange(len(node)), size), ids.reshape(-1), np.full(ids.size, -np.inf, np.float32),
                np.zeros(ids.size, np.uint8), size,
            )
            keep = ids != node[owner]
            owner, ids, sims, old = owner[keep], ids[keep], sims[keep], old[keep]
            yield _state(node, 0, batch.column("vec"), np.bincount(owner, minlength=len(node)), ids, sims, old)

    return run


def _round(pools: DataFrame, joined: int, degree: int, width: int) -> DataFrame:
    """Pools after one round of neighbours of neighbours."""
    named = pools.mapInArrow(_members(joined, degree), MEMBER)
    own = pools.mapInArrow(_own(degree), "node long, vec binary, least float")
    steps = named.select(F.col("id").alias("from"), F.col("node").alias("to"), "old")
    lists = steps.join(own, steps["to"] == own["node"]).select(
        F.col("from").alias("node"), F.lit(0).alias("kind"), F.col("to").alias("id"), "vec", "least", "old"
    )
    # A node stands in its own list, for those who do not know it yet.
    itself = own.select(
        "node", F.lit(0).alias("kind"), F.col("node").alias("id"), "vec",
        F.lit(float("inf")).cast("float").alias("least"), F.lit(True).alias("old"),
    )
    meeting = lists.unionByName(itself).unionByName(named).repartition("node").sortWithinPartitions("node", "kind")
    found = meeting.mapInArrow(_descend(width, degree), STATE)
    return _by_node(pools.mapInArrow(_opened(joined), STATE).unionByName(found), degree)


def _by_node(rows: DataFrame, most: int) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "kind").mapInArrow(_merge(most), STATE)


def _turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pool's node as found for the nodes in the pool."""
    for batch in batches:
        ids, counts = _numbers(batch.column("ids"), "<i8")
        sims = _numbers(batch.column("sims"), "<f4")[0]
        yield _found_rows(ids, np.repeat(batch.column("node").to_numpy(), counts), sims, len(ids) + 1)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, counts = _numbers(batch.column("ids"), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("node").to_numpy(), counts)), pa.array(ids)], ["node", "id"])


def _unopened(most: int):
    """How many of the first ``most`` entries of all pools are not old."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = total = 0
        for batch in batches:
            old, counts = _numbers(batch.column("old"), "u1")
            top = _places(np.repeat(np.arange(len(counts)), counts)) < most
            fresh, total = fresh + int((old[top] == 0).sum()), total + int(top.sum())
        yield pa.RecordBatch.from_arrays([pa.array([fresh]), pa.array([total])], ["fresh", "total"])

    return run


def _count_unopened(pools: DataFrame, most: int) -> tuple[int, int]:
    """How many of the first ``most`` entries of all pools are not old, and how
    many entries that are."""
    found = pools.mapInArrow(_unopened(most), "fresh long, total long").agg(F.sum("fresh"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


def _share_unopened(pools: DataFrame, most: int) -> float:
    fresh, total = _count_unopened(pools, most)
    return fresh / max(total, 1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, ids, vecs from rows (node, id, vec) sorted by node."""
    for batch in _whole_groups(batches):
        nodes, counts = np.unique(batch.column("node").to_numpy(), return_counts=True)
        vecs, bounds = flat(batch.column("vec"))
        width = int(bounds[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes), binary(batch.column("id").to_numpy(), counts), binary(vecs, counts * width)], ["node", "ids", "vecs"]
        )


def build(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", degree: int = DEGREE,
    joined: tuple[int, ...] = JOINED,
) -> Index:
    """An index of all rows, in written tables that ``Index.remove`` removes.

    Rows without an identifier, and rows whose vector is null, empty, zero,
    holds a null or non-finite entry or has another length than the commonest
    one, take no part. Of rows with one identifier the least vector counts.
    Other columns are ignored, and an empty table gives an empty index.
    """
    spark = rows.sparkSession
    found, d = _taking_part(rows, id_column, vector_column)
    found, found_folder = stored(found.select("vec_id", "vector", *_keys(F.col("vector")), "norm"), "ann-rows")
    distinct, distinct_folder, n = _numbered(spark, found.groupBy("one", "two").agg(F.min("vector").alias("vector")))
    longest = found.agg(F.max("norm")).first()[0] or 0.0
    nodes, nodes_folder = stored(
        distinct.mapInArrow(_coded(longest, d), f"{distinct.select('node', 'one', 'two', 'vector').schema.simpleString()[7:-1]}, vec binary"),
        "ann-nodes",
    )
    members, members_folder = stored(
        found.select("vec_id", "one", "two").join(nodes.select("one", "two", "node"), ["one", "two"]).select("node", "vec_id"),
        "ann-members",
    )
    pools, folder = stored(nodes.mapInArrow(_first_pools(n, joined[0]), STATE), "ann-pools")
    release(spark, found_folder, distinct_folder)
    for step in range(MOST_ROUNDS if n > 1 else 0):
        now = joined[min(step, len(joined) - 1)]
        before, (pools, folder) = folder, stored(_round(pools, now, degree, d + 5), "ann-pools")
        release(spark, before)
        if now == joined[-1] and _share_unopened(pools, degree) <= SETTLED:
            break
    both = _by_node(pools.unionByName(pools.mapInArrow(_turned, STATE)), 2 * degree)
    entries = both.mapInArrow(_entries, "node long, id long")
    listed = entries.join(nodes.select(F.col("node").alias("id"), "vec"), "id").select("node", "id", "vec")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"ann_lists_{uuid.uuid4().hex}"
    lists_folder = new_folder(spark, "ann-lists")
    packed = listed.repartition(buckets, "node").sortWithinPartitions("node").mapInArrow(_packed, "node long, ids binary, vecs binary")
    packed.write.bucketBy(buckets, "node").sortBy("node").option("path", lists_folder).saveAsTable(name)
    release(spark, folder)
    return Index(nodes, members, name, d, n, [nodes_folder, members_folder, lists_folder])


# The search

def _start(ids: np.ndarray, vecs: np.ndarray, width: int):
    """Pools of the fixed starts and, if the query has a node of its own, that
    node, which is open, and its neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "vecs", 4 << 20):
                queries = _decode(_codes(part.column("vec"), width))
                count = len(queries)
                sims = queries @ vecs.T
                own = np.flatnonzero(part.column("own").is_valid().to_numpy(zero_copy_only=False))
                own_vec = _decode(_codes(part.column("own_vec").take(pa.array(own)), width))
                near, counts = _numbers(part.column("ids"), "<i8")
                row = np.repeat(np.arange(count), counts)
                near_sims = np.einsum("ij,ij->i", _decode(_codes(part.column("vecs"), width)), queries[row])
                old = np.zeros(count * len(ids) + len(own) + len(near), np.uint8)
                old[count * len(ids): count * len(ids) + len(own)] = 1
                owner, found, sims, old = _best(
                    np.concatenate([np.repeat(np.arange(count), len(ids)), own, row]),
                    np.concatenate([np.tile(ids, count), part.column("own").take(pa.array(own)).to_numpy(), near]),
                    np.concatenate([sims.reshape(-1), (queries[own] * own_vec).sum(axis=1), near_sims]), old, POOL,
                )
                yield _state(
                    part.column("node").to_numpy(), 0, part.column("vec"), np.bincount(owner, minlength=count), found, sims, old
                )

    return run


def _next(old: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The entries that a round opens: of each pool the best unopened ones."""
    fresh = np.flatnonzero(old == 0)
    owner = np.repeat(np.arange(len(counts)), counts)[fresh]
    return fresh[_places(owner) < most]


def _frontier(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = _numbers(batch.column("ids"), "<i8")
            sims, old = _numbers(batch.column("sims"), "<f4")[0], _numbers(batch.column("old"), "u1")[0]
            at = _next(old, counts, most)
            owner = np.repeat(np.arange(len(counts)), counts)[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[at]), batch.column("node").take(pa.array(owner)), batch.column("vec").take(pa.array(owner)),
                    pa.array(_least_of(counts, sims, POOL)[owner]),
                ],
                ["node", "query", "vec", "least"],
            )

    return run


def _after_opening(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = _numbers(batch.column("ids"), "<i8")
            sims, old = _numbers(batch.column("sims"), "<f4")[0], _numbers(batch.column("old"), "u1")[0].copy()
            old[_next(old, counts, most)] = 1
            yield _state(batch.column("node").to_numpy(), 0, batch.column("vec"), counts, ids, sims, old)

    return run


def _extended(most: int):
    """Pools with the best ``most`` entries opened, and what was found for them
    as a list beside them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = _numbers(batch.column("ids"), "<i8")
            sims, old = _numbers(batch.column("sims"), "<f4")[0], _numbers(batch.column("old"), "u1")[0].copy()
            old[_next(old, counts, most)] = 1
            lists = batch.column("found")
            found = lists.flatten()
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            more, many = _numbers(found.field("ids"), "<i8")
            owner, ids, sims, old = _best(
                np.concatenate([np.repeat(np.arange(batch.num_rows), counts), np.repeat(rows, many)]), np.concatenate([ids, more]),
                np.concatenate([sims, _numbers(found.field("sims"), "<f4")[0]]),
                np.concatenate([old, np.zeros(len(more), np.uint8)]), POOL,
            )
            counts = np.bincount(owner, minlength=batch.num_rows)
            yield _state(batch.column("node").to_numpy(), 0, batch.column("vec"), counts, ids, sims, old)

    return run


def _opening(pools: DataFrame, lists: DataFrame, most: int, width: int, few: bool) -> DataFrame:
    """Pools after their best ``most`` unopened entries have been opened."""
    opened = pools.mapInArrow(_frontier(most), "node long, query long, vec binary, least float")
    met = (F.broadcast(opened) if few else opened).join(lists, "node")
    found = met.select("query", "vec", "least", "ids", "vecs").mapInArrow(_scored(width), STATE)
    if not few:
        return _by_node(pools.mapInArrow(_after_opening(most), STATE).unionByName(found), POOL)
    found = found.groupBy("node").agg(F.collect_list(F.struct("ids", "sims")).alias("found"))
    return pools.join(F.broadcast(found), "node", "left").select("node", "vec", "ids", "sims", "old", "found").mapInArrow(
        _extended(most), STATE
    )


def _scored(width: int):
    """The neighbours of opened nodes that come into the query's pool."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "vecs", 4 << 20):
                ids, counts = _numbers(part.column("ids"), "<i8")
                row = np.repeat(np.arange(len(counts)), counts)
                queries = _decode(_codes(part.column("vec"), width))
                sims = np.einsum("ij,ij->i", _decode(_codes(part.column("vecs"), width)), queries[row])
                keep = sims > part.column("least").to_numpy()[row]
                yield _found_rows(part.column("query").to_numpy()[row[keep]], ids[keep], sims[keep].astype(np.float32), POOL)

    return run


def _query_codes(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _encode(np.hstack([matrix(batch, d).astype(np.float64), np.zeros((batch.num_rows, 1))]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("node", "one", "two")), binary(codes.reshape(-1), np.full(len(codes), codes.shape[1]))],
                ["node", "one", "two", "vec"],
            )

    return run


def search(
    index: Index, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k rows of the index
    with the largest inner product that the search finds, in double precision
    on the vectors as they are, ties by the smaller vec_id; a row with the
    query's own identifier is left out.

    Queries are rows as those of ``build`` and take part under the same
    conditions; one of another length than the index's vectors does not.
    There are fewer than k rows only if the index has no more. The result is a
    written table.
    """
    spark = queries.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    taken, d = _taking_part(queries, id_column, vector_column)
    if not index.n or d != index.d:
        return spark.createDataFrame([], schema)
    asked, asked_folder = stored(taken.select(F.col("vec_id").alias("query_id"), "vector", *_keys(F.col("vector"))), "ann-queries")
    distinct, distinct_folder, _ = _numbered(spark, asked.groupBy("one", "two").agg(F.min("vector").alias("vector")))
    width, apart = index.width, -(-index.n // STARTS)
    starts = index.nodes.where(F.col("node") % apart == 0).select("node", "vec").toArrow().combine_chunks()
    start_vecs = _decode(_codes(starts["vec"].combine_chunks(), width))
    # The extra coordinate of a query is zero.
    coded = distinct.mapInArrow(_query_codes(d), "node long, one long, two long, vec binary")
    own = index.nodes.select("one", "two", F.col("node").alias("own"), F.col("vec").alias("own_vec"))
    lists = spark.table(index.lists)
    with_lists = coded.join(own, ["one", "two"], "left").join(lists.withColumnRenamed("node", "own"), "own", "left")
    pools, folder = stored(
        with_lists.select("node", "vec", "own", "own_vec", "ids", "vecs").mapInArrow(
            _start(starts["node"].to_numpy(), start_vecs, width), STATE),
        "ann-pools",
    )
    step = 0
    while left := _count_unopened(pools, POOL)[0]:
        most, step = OPENED[min(step, len(OPENED) - 1)], step + 1
        before, (pools, folder) = folder, stored(_opening(pools, lists, most, width, left <= FEW), "ann-pools")
        release(spark, before)
    pairs = pools.mapInArrow(_entries, "node long, id long").withColumnRenamed("node", "query")
    left = distinct.select(F.col("node").alias("query"), F.col("vector").alias("x"))
    right = index.nodes.select(F.col("node").alias("id"), F.col("vector").alias("y"))
    products = F.zip_with("x", "y", lambda x, y: x.cast("double") * y.cast("double"))
    scored = pairs.join(right, "id").join(left, "query").select(
        "query", "id", F.aggregate(products, F.lit(0.0), lambda s, x: s + x).alias("score")
    )
    by_copy = Window.partitionBy("node").orderBy("vec_id")
    copies = index.members.withColumn("copy", F.row_number().over(by_copy)).where(F.col("copy") <= k + 1)
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = scored.join(copies, scored["id"] == copies["node"]).select(
        "query", "score", "vec_id", F.row_number().over(nearest).alias("place")).where(F.col("place") <= k + 1)
    who = asked.join(distinct.select("one", "two", F.col("node").alias("query")), ["one", "two"]).select("query_id", "query")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    result = who.join(top, "query").where("vec_id <> query_id").select(
        "query_id", F.row_number().over(rank).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    result = written(result, "ann-nearest")
    release(spark, folder, asked_folder, distinct_folder)
    return result
