"""Benchmark items inside documents, by MinHash containment.

An item counts as contained when at least four fifths of its different 5-word
shingles occur in the document. Items are partitioned by size. In each
partition an item's sketch is its smallest shingle hashes, as many as the
largest item of the partition may miss and one more, so an item that is
contained always shares some of them, however long the document is: of an
item of q shingles q // 5 may be missing. The document's side of the sketch is
every hash up to the largest one kept in a partition, which shrinks with the
size of the items, not with that of the document. Pairs that share enough of a
sketch are verified by counting all shingles of the item in the document.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from telmart.llm.shared import flat, slices, text_of
from telmart.llm.shingles import distinct, shingles, words

WORDS = 5
# Bytes of item text that one pass holds in the driver and each worker.
BLOCK_BYTES = 16 << 20


class Items:
    """The shingles and sketches of a block of items."""

    def __init__(self, texts: list[str], n: int = WORDS):
        data, offsets = flat(pa.array(texts, pa.string()))
        _, _, hashes, bounds = words(data, offsets)
        values, before = distinct(*shingles(hashes, bounds, n))
        self.n = n
        self.sizes = np.diff(before)
        self.misses = self.sizes // 5
        owner = np.repeat(np.arange(len(texts)), self.sizes)
        # Partition p holds the items of 2^p up to 2^(p+1) - 1 shingles.
        part = np.frexp(np.maximum(self.sizes, 1).astype(float))[1] - 1
        self.kept = np.zeros(len(texts), np.int64)
        self.sketches = []
        for p in np.unique(part[self.sizes > 0]):
            here = np.flatnonzero((part == p) & (self.sizes > 0))
            most = int(self.misses[here].max()) + 1
            self.kept[here] = np.minimum(most, self.sizes[here])
            place = np.arange(len(values)) - before[owner]
            chosen = np.flatnonzero(np.isin(owner, here) & (place < most))
            self.sketches.append(self._indexed(values[chosen], owner[chosen]))
        self.all = self._indexed(values, owner)

    @staticmethod
    def _indexed(values, owner):
        order = np.argsort(values, kind="stable")
        keys, first, many = np.unique(values[order], return_index=True, return_counts=True)
        return keys, first, many, owner[order]

    @staticmethod
    def _shared(index, text: np.ndarray, value: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
        """How many hashes of each (text, item) the index has; (text, value)
        without repeats. Pairs come as text * items + item."""
        keys, first, many, owner = index
        at = np.minimum(np.searchsorted(keys, value), max(len(keys) - 1, 0))
        repeat = many[at]
        stop = np.cumsum(repeat)
        item = owner[np.repeat(first[at] - (stop - repeat), repeat) + np.arange(stop[-1] if len(stop) else 0)]
        return np.unique(np.repeat(text, repeat) * items + item, return_counts=True)

    @staticmethod
    def _present(index, text, value):
        """The different (text, value) whose value the index holds."""
        keys = index[0]
        if not len(keys):
            return text[:0], value[:0]
        hit = np.flatnonzero(value <= keys[-1])
        at = np.searchsorted(keys, value[hit])
        hit = hit[keys[at] == value[hit]]
        text, value = text[hit], value[hit]
        order = np.lexsort((value, text))
        text, value = text[order], value[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
        return text[new], value[new]

    def contained(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared shingles) of every item contained in a text."""
        _, _, hashes, bounds = words(data, offsets)
        value, before = shingles(hashes, bounds, self.n)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        items = len(self.sizes)
        pairs = []
        for sketch in self.sketches:
            pair, shared = self._shared(sketch, *self._present(sketch, text, value), items)
            item = pair % items
            pairs.append(pair[shared >= self.kept[item] - self.misses[item]])
        pairs = np.sort(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        if not len(pairs):
            return pairs, pairs, pairs
        candidates = np.zeros(len(offsets) - 1, bool)
        candidates[pairs // items] = True
        own = candidates[text]
        pair, shared = self._shared(self.all, *self._present(self.all, text[own], value[own]), items)
        at = np.searchsorted(pair, pairs)
        shared = shared[at]
        enough = 5 * shared >= 4 * self.sizes[pairs % items]
        return pairs[enough] // items, pairs[enough] % items, shared[enough]


def contained_items(
    documents: DataFrame, benchmark: DataFrame, n: int = WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles for each document and item that it
    contains; whole texts, all items against all documents.

    Words are runs of bytes other than white space, A-Z in lower case. A text
    of fewer than five words is one shingle, so a short item is found in equal
    texts only; items without words are found nowhere. Repeated rows of either
    table count one by one, null identifiers stay null. A benchmark above
    ``block_bytes`` is taken in blocks of about that size, one pass each.
    """
    found = None
    for ids, texts, id_type in _blocks(benchmark, block_bytes):
        part = _search(documents, ids, texts, n, id_type)
        found = part if found is None else found.unionByName(part)
    return found


def without_items(
    documents: DataFrame, benchmark: DataFrame, n: int = WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that contain no item, with all their columns; nothing is
    moved."""
    for _, texts, _ in _blocks(benchmark, block_bytes):
        documents = _clean(documents, texts, n)
    return documents


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[str], DataType]]:
    """The items in blocks that are bounded by their bytes, so that each may
    come to the driver."""
    items = benchmark.select("item_id", text_of().alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for block in range(blocks):
        rows = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = rows.collect()
        yield [row[0] for row in rows], [row[1] for row in rows], items.schema["item_id"].dataType


def _clean(documents: DataFrame, texts: list[str], n: int) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(Items(texts, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keep = np.ones(part.num_rows, bool)
                keep[shared.value.contained(*flat(part.column("text")))[0]] = False
                yield part.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def _search(documents: DataFrame, ids: list, texts: list[str], n: int, id_type: DataType) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast((ids, Items(texts, n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, index = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                text, item, count = index.contained(*flat(part.column("text")))
                if len(text):
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id").take(pa.array(text)), pa.array([names[i] for i in item], wanted),
                        pa.array(count, pa.int64()), pa.array(index.sizes[item], pa.int64()),
                    ], ["doc_id", "item_id", "n_shared", "n_shingles"])

    wanted = to_arrow_type(id_type)
    rows = documents.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, item_id {id_type.simpleString()}, n_shared long, n_shingles long")
