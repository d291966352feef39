"""Removal of repeated byte strings by a sparse suffix array.

A byte goes when it lies in a string of LENGTH bytes that starts at another
place too, in the same document or any other. Sorting the suffixes at every
byte would move each text some hundred times over, so suffixes are taken at
places that the content chooses: of each SPAN neighbouring places the one whose
eight bytes hash lowest. Two equal strings choose the same place, which lies in
their first SPAN bytes, so their suffixes from there agree in at least
LENGTH - SPAN bytes. Each suffix stands for the run of string starts that chose
it.

Suffixes are dealt out by sampled splitters over their leading bytes, a digest
of those that must agree, and the row, so that a passage in a third of all
documents is spread over tasks. A task sorts its bucket by multikey quicksort:
word by word, only what is still tied. Suffixes that agree form a group;
the groups at the two ends of a bucket may go on in the next one and are
compared across buckets. Within a group
- runs whose whole stretch of bytes agrees are repeated from end to end;
- for the others, and one of each kind of agreeing runs, the strings
  themselves are compared one by one, through a hash of all their bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telmart.llm.packing import pack, smallest, steps, unpack
from telmart.llm.shared import flat, numbered, release, slices, stored, written
from telmart.llm.shingles import mix, span_hashes

LENGTH = 400
# Strings compared by a task before it deals them out.
STRINGS_AT_ONCE = 1 << 20
# Text whose places a task looks at together; it takes some 60 times as much.
BYTES_AT_ONCE = 2 << 20
BLOCKS_PER_PARTITION = 4
_LOW = np.uint64(0xFFFFFFFF)
# Fixed values of the string hash: an odd base and its inverse modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def span_of(length: int) -> int:
    """Places to choose from; the eight bytes at each lie within the string."""
    if length < 16:
        raise ValueError("strings must have at least 16 bytes")
    return min(length * 5 // 8, length - 8)


def suffixes(data: np.ndarray, offsets: np.ndarray, length: int):
    """The chosen places of texts laid end to end, in order: the place, the
    first and the last string start that chose it, and the text."""
    span = span_of(length)
    sizes = np.diff(offsets)
    fits = np.flatnonzero(sizes >= length)
    if not len(fits):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(np.ndarray((len(data),), "<u8", buffer=padded.data, strides=(1,)))
    # The high half decides, then the place: the leftmost of equals.
    ranked = (mix(eight) & ~_LOW) | np.arange(len(data), dtype=np.uint64)
    blocks = -(-len(data) // span) + 1
    ranked = np.concatenate([ranked, np.full(blocks * span - len(data), ~np.uint64(0))]).reshape(blocks, span)
    ahead = np.minimum.accumulate(ranked, axis=1).reshape(-1)
    behind = np.minimum.accumulate(ranked[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    marks = np.zeros(len(data) + 1, np.int8)
    marks[offsets[fits]] += 1
    marks[offsets[fits] + sizes[fits] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(marks[:-1], dtype=np.int8))
    chosen = (np.minimum(behind[starts], ahead[starts + span - 1]) & _LOW).astype(np.int64)
    text = np.searchsorted(offsets, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return chosen[first], starts[first], starts[last], text[first]


SUFFIX = "lead long, same long, run long, row long, place long, back int, ahead int"


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int):
    """Texts as they are, or one very long text in stretches that overlap so
    that each string lies in one of them whole: (where it begins, bytes,
    offsets)."""
    if len(offsets) > 2 or len(data) <= 2 * BYTES_AT_ONCE:
        yield 0, data, offsets
        return
    for base in range(0, len(data) - length + 1, BYTES_AT_ONCE):
        part = data[base: base + BYTES_AT_ONCE + length - 1]
        yield base, part, np.array([0, len(part)])


def _listed(texts: DataFrame, length: int) -> DataFrame:
    """The suffixes of all texts: their first eight bytes, the digest of the
    bytes that must agree, the digest of the whole run, the row, the place, and
    how far before it the first and behind that the last start lie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", BYTES_AT_ONCE):
                rows = piece.column("row").to_numpy()
                for base, data, offsets in _stretches(*flat(piece.column("text")), length):
                    place, first, last, text = suffixes(data, offsets, length)
                    if not len(place):
                        continue
                    padded = np.concatenate([data, np.zeros(8, np.uint8)])
                    eight = np.ndarray((len(data),), ">u8", buffer=padded.data, strides=(1,))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(eight[place].astype(np.uint64).view(np.int64)),
                        pa.array(span_hashes(data, place, place + length - span_of(length)).view(np.int64)),
                        pa.array(span_hashes(data, first, last + length).view(np.int64)),
                        pa.array(rows[text]), pa.array(place - offsets[text] + base),
                        pa.array((place - first).astype(np.int32)), pa.array((last - first).astype(np.int32)),
                    ], ["lead", "same", "run", "row", "place", "back", "ahead"])

    return texts.select("row", "text").mapInArrow(run, SUFFIX)


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """The order of strings given as columns of words, by multikey quicksort:
    sorted by one word, and only ties go on to the next."""
    order = np.argsort(words[0], kind="stable")
    first = words[0][order]
    group = np.concatenate([[0], np.cumsum(first[1:] != first[:-1])]) if len(order) else order
    for word in words[1:]:
        tied = np.zeros(len(order), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        sub = np.lexsort((word[order[at]], group[at]))
        order[at] = order[at[sub]]
        value = word[order]
        new = np.zeros(len(order), bool)
        new[1:] = group[1:] != group[:-1]
        new[at[1:]] |= (value[at[1:]] != value[at[1:] - 1]) & (at[1:] > 0)
        group = np.cumsum(new)
    return order


def _compared(rows: DataFrame) -> DataFrame:
    """Sorts every bucket and compares neighbours. Returns the rows that count
    with ``kind``: whole (repeated from end to end), open (to be compared string
    by string) and edge (one of the alike runs of a group at an end of a
    bucket, and ``alike``, their number there)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(batch.num_rows for batch in held):
            return
        bucket = pa.Table.from_batches(held).combine_chunks()
        column = {name: bucket.column(name).to_numpy() for name in bucket.column_names}
        kind = [column["lead"], column["same"], column["run"], column["back"], column["ahead"]]
        order = multikey_order([kind[0].view(np.uint64), *kind[1:]])
        sort = [x[order] for x in kind]
        new_group = np.ones(len(order), bool)
        new_group[1:] = (sort[0][1:] != sort[0][:-1]) | (sort[1][1:] != sort[1][:-1])
        new_class = new_group.copy()
        for x in sort[2:]:
            new_class[1:] |= x[1:] != x[:-1]
        group, own = np.cumsum(new_group) - 1, np.cumsum(new_class) - 1
        size, alike = np.bincount(group), np.bincount(own)
        lone = alike[own] == 1
        singles = np.bincount(group, lone)
        ends = (group == 0) | (group == group[-1])
        opened = ~ends & (size[group] > 1) & (lone | (new_class & (singles[group] > 0)))
        # Of alike runs at an end one goes on, with their number.
        for name, chosen in (("whole", ~lone), ("open", opened), ("edge", ends & new_class)):
            at = order[chosen]
            if len(at):
                part = bucket.take(pa.array(at)).append_column("alike", pa.array(alike[own[chosen]], pa.int64()))
                for batch in part.to_batches():
                    yield batch.append_column("kind", pa.array([name] * batch.num_rows))

    return rows.repartitionByRange("lead", "same", "row").mapInArrow(run, f"{SUFFIX}, alike long, kind string")


def _across(compared: DataFrame) -> DataFrame:
    """The same decisions for the groups at the ends of buckets, by counts."""
    own = ["lead", "same", "run", "back", "ahead"]
    edge = compared.where("kind = 'edge'").drop("kind", "alike")
    classes = compared.where("kind = 'edge'").groupBy(*own).agg(
        F.sum("alike").alias("alike"), F.min(F.struct("row", "place")).alias("chosen")
    )
    groups = classes.groupBy("lead", "same").agg(
        F.sum("alike").alias("size"), F.sum((F.col("alike") == 1).cast("long")).alias("singles")
    ).where("size > 1")
    # Written, so that the join deals both sides out and can split a frequent one.
    known = written(classes.join(groups, ["lead", "same"]), "suffix-classes")
    rows = edge.join(known, own)
    whole = rows.where("alike > 1").withColumn("kind", F.lit("whole"))
    opened = rows.where("alike = 1 OR (singles > 0 AND chosen = struct(row, place))").withColumn("kind", F.lit("open"))
    return whole.unionByName(opened).select(*compared.columns)


def _string_hashes(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each start, from running sums."""
    power = np.full(len(data), _BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=total[1:])
    back = np.full(len(data), _INVERSE, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix((total[start + length] - total[start]) * back[start])


def _by_string(texts: DataFrame, opened: DataFrame, length: int, blocks: int) -> DataFrame:
    """Compares the strings of open runs one by one. Returns source (the part
    of the row number that names its scan), and packed rows and starts."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        count = 0
        for batch in batches:
            for i in range(batch.num_rows):
                data, _ = flat(batch.column("text").slice(i, 1))
                same, place, back, ahead = (
                    batch.column("runs").slice(i, 1).flatten().field(name).to_numpy()
                    for name in ("same", "place", "back", "ahead")
                )
                many = ahead.astype(np.int64) + 1
                start = np.repeat(place - back, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = np.repeat(np.arange(len(many)), many)
                key = _string_hashes(data, start, length)
                key = mix(key ^ mix(same.view(np.uint64)[at] + (place[at] - start).astype(np.uint64)))
                held.append((key, np.full(len(start), batch.column("row")[i].as_py()), start))
                count += len(start)
                if count > STRINGS_AT_ONCE:
                    yield from deal(held)
                    held, count = [], 0
        if held:
            yield from deal(held)

    def deal(held):
        """What occurs twice here is decided here; of each string one goes on."""
        key, row, start = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(key, kind="stable")
        key, row, start = key[order], row[order], start[order]
        new = np.append(True, key[1:] != key[:-1])
        twice = np.zeros(len(key), bool)
        twice[1:] = ~new[1:]
        again = ~new[1:] & new[:-1]
        twice[:-1] |= again
        block = np.where(new, (mix(key) % np.uint64(blocks)).astype(np.int64), -1)
        sent = np.flatnonzero(new)
        sent = sent[np.argsort(block[sent], kind="stable")]
        edges = np.searchsorted(block[sent], np.arange(blocks + 1))
        rows = [b for b in range(blocks) if edges[b + 1] > edges[b]]
        packed = []
        for b in rows:
            at = sent[edges[b]: edges[b + 1]]
            least = row[at].min()
            packed.append(pack(
                steps(key[at]), np.array([least]), smallest(row[at] - least), smallest(start[at]),
                twice[at].astype(np.uint8),
            ))
        repeated = np.flatnonzero(twice)
        out = list(_by_source(row[repeated], start[repeated])) if len(repeated) else []
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(rows + [None] * len(out), pa.int32()),
            "source": pa.array([None] * len(rows) + [x for x, _ in out], pa.int64()),
            "payload": pa.array(packed + [x for _, x in out], pa.binary()),
        })

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for block, source, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if block is None:
                    yield pa.RecordBatch.from_pydict({
                        "source": pa.array([source], pa.int64()), "payload": pa.array([payload], pa.binary())})
                    continue
                if block != now:
                    yield from settle(held)
                    now, held = block, []
                held.append(unpack(payload))
        yield from settle(held)

    def settle(held):
        if not held:
            return
        key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in held])
        row = np.concatenate([x[2].astype(np.int64) + x[1][0] for x in held])
        start = np.concatenate([x[3].astype(np.int64) for x in held])
        known = np.concatenate([x[4] for x in held]).astype(bool)
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        found = order[(np.bincount(group)[group] > 1) & ~known[order]]
        if len(found):
            out = list(_by_source(row[found], start[found]))
            yield pa.RecordBatch.from_pydict({
                "source": pa.array([x for x, _ in out], pa.int64()), "payload": pa.array([x for _, x in out], pa.binary())})

    runs = opened.groupBy("row").agg(F.collect_list(F.struct("same", "place", "back", "ahead")).alias("runs"))
    dealt = texts.select("row", "text").join(runs, "row").mapInArrow(strings, "block int, source long, payload binary")
    # What is decided already has no block; it stays spread over all tasks.
    spread = F.coalesce(F.col("block").cast("long"), F.xxhash64("payload"))
    return dealt.repartition(spread).sortWithinPartitions("block").mapInArrow(merge, "source long, payload binary")


def _by_source(row: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    source = row >> 33
    edges = np.concatenate([[0], np.flatnonzero(source[1:] != source[:-1]) + 1, [len(row)]])
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield int(source[a]), pack(steps(row[a:b]), smallest(start[a:b]))


def _joined_starts(found: DataFrame, length: int) -> DataFrame:
    """Runs of string starts as byte ranges: row, first, stop."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for source, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if source != now:
                    yield from settle(held)
                    now, held = source, []
                held.append(unpack(payload))
        yield from settle(held)

    def settle(held):
        if not held:
            return
        row = np.concatenate([np.cumsum(x[0]) for x in held])
        start = np.concatenate([x[1].astype(np.int64) for x in held])
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        yield pa.RecordBatch.from_pydict({"row": row[first], "first": start[first], "stop": start[last] + length})

    return found.repartition("source").sortWithinPartitions("source").mapInArrow(run, "row long, first long, stop long")


def repeated_ranges(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte ranges (row, first, stop) that repeated strings of numbered texts
    cover; they may overlap."""
    blocks = BLOCKS_PER_PARTITION * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared, compared_folder = stored(_compared(_listed(texts, length)), "suffix-groups")
    # The sort's shuffle is done with, as are later those that make the ranges.
    release(texts.sparkSession)
    across = written(_across(compared), "suffix-edges")
    decided = compared.where("kind <> 'edge'").unionByName(across)
    whole = decided.where("kind = 'whole'").select(
        "row", (F.col("place") - F.col("back")).alias("first"),
        (F.col("place") - F.col("back") + F.col("ahead") + length).alias("stop"),
    )
    found = _by_string(texts, decided.where("kind = 'open'"), length, blocks)
    ranges = written(whole.unionByName(_joined_starts(found, length)), "suffix-ranges", compression="zstd")
    release(texts.sparkSession, compared_folder)
    return ranges


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (maximal removed runs as first
    and stop byte) and kept (the bytes that are left) of every document.

    Texts are UTF-8 bytes; a null text is empty, and texts shorter than
    ``length`` lose nothing. Every copy of a repeated string goes, repeated rows
    included; rows are treated one by one whatever their identifiers, null or
    repeated. Other columns are ignored.
    """
    rows = numbered(documents)
    ranges = repeated_ranges(rows, length).groupBy("row").agg(
        F.collect_list(F.struct("first", "stop")).alias("ranges")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = flat(piece.column("text"))
                size = np.diff(offsets)
                removed, spans, kept = np.zeros(len(size), np.int64), [], []
                for i in range(len(size)):
                    text = data[offsets[i]: offsets[i + 1]]
                    here = piece.column("ranges").slice(i, 1)
                    if here.null_count:
                        spans.append([])
                        kept.append(text.tobytes())
                        continue
                    first, stop = (here.flatten().field(x).to_numpy() for x in ("first", "stop"))
                    order = np.argsort(first)
                    first, reach = first[order], np.maximum.accumulate(stop[order])
                    new = np.append(True, first[1:] > reach[:-1])
                    begin = first[new]
                    end = reach[np.append(np.flatnonzero(new)[1:], len(first)) - 1]
                    spans.append([{"first": int(a), "stop": int(b)} for a, b in zip(begin, end)])
                    removed[i] = (end - begin).sum()
                    edges = np.concatenate([[0], np.stack([begin, end], axis=1).ravel(), [len(text)]])
                    kept.append(b"".join(text[a:b].tobytes() for a, b in edges.reshape(-1, 2)))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed),
                    pa.array([len(x) for x in spans], pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary()),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(ranges, "row", "left").select("doc_id", "text", "ranges").mapInArrow(
        run,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long,"
        " spans array<struct<first: long, stop: long>>, kept binary",
    )
