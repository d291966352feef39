"""Token identifiers of all documents in seekable binary files.

A file holds the identifiers of a range of documents as little-endian unsigned
32-bit integers, each document closed by an end identifier, in independent
zstandard frames (see frames.py). The last frame is the index: the number of
documents, whether each has an identifier, their identifiers, and the position
of each one's first token in the file. Frames end with a document once they
hold FRAME_TOKENS, and a longer document goes on in further frames.
"""

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from telmart.llm.frames import FrameReader, FrameWriter, created, opened
from telmart.llm.shared import flat, open_folder, slices, text_of, written
from telmart.llm.shingles import span_hashes

END_ID = 2
FRAME_TOKENS = 1 << 17
LONGEST_FRAME = 1 << 24
CHUNKS_AT_ONCE = 4096
# Pieces whose identifiers a worker keeps for later batches: some 40 MB.
PIECES_KEPT = 1_000_000


class Encoder:
    """Encodes many texts with a byte-level BPE of the tokenizers library.

    The pattern of such a tokenizer always begins a new word at a blank or line
    break between two other characters, so texts are cut there and each
    different piece of a batch is encoded once. Pieces are joined to long
    strings for the library, and its identifiers are told apart by the number
    of bytes that each stands for. The library finds the strings of its added
    tokens in a text before its pattern; pieces with such a string are not cut
    in or next to it, and are encoded by themselves.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        added = self._library.get_added_tokens_decoder().values()
        self._added = [x for x in (token.content.encode() for token in added) if x]
        # Of an added token that holds white space, joined pieces could make one.
        self._apart = any(x.split() != [x] for x in self._added)
        size = self._library.get_vocab_size()
        self._bytes = np.array([len(self._library.id_to_token(i) or "") for i in range(size)], np.int64)
        # White space beyond ASCII starts with one of four bytes, so around
        # characters that do no cut is made.
        self._after = np.zeros(256, bool)
        self._after[0x21:0x7F] = True
        self._after[0xC3:0xF5] = True
        self._after[[0xE1, 0xE2, 0xE3]] = False
        self._forget()

    def _places(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings of added tokens begin and end."""
        raw, found = data.tobytes(), []
        for token in self._added:
            at = raw.find(token)
            while at >= 0:
                found.append((at, at + len(token)))
                at = raw.find(token, at + 1)
        begin, end = np.array(sorted(found), np.int64).reshape(-1, 2).T
        return begin, end

    def _cuts(self, data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        blank = np.flatnonzero((data == 0x20) | (data == 0x0A))
        blank = blank[(blank > 2) & (blank + 1 < len(data))]
        before = data[blank - 1]
        plain = (before > 0x20) & (before < 0x7F)
        wide = (before >= 0x80) & (data[blank - 2] != 0xC2) & ~np.isin(data[blank - 3], (0xE1, 0xE2, 0xE3))
        blank = blank[(plain | wide) & self._after[data[blank + 1]]]
        text = np.searchsorted(offsets, blank, "right") - 1
        blank = blank[(blank > offsets[text]) & (blank + 1 < offsets[text + 1])]
        if len(begin):
            # The blanks before and behind an added token are its neighbours' too.
            marks = np.zeros(len(data) + 2, np.int32)
            np.add.at(marks, np.maximum(begin - 1, 0), 1)
            np.add.at(marks, end + 1, -1)
            blank = blank[np.cumsum(marks)[blank] == 0]
        return np.sort(np.concatenate([blank, offsets[:-1][np.diff(offsets) > 0]]))

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of pieces that each start with a blank, and how many."""
        groups = [pieces[i: i + CHUNKS_AT_ONCE] for i in range(0, len(pieces), CHUNKS_AT_ONCE)]
        ids, sizes = [], []
        for group in groups:
            out = np.array(
                self._library.encode_batch_fast([b"".join(group).decode()], add_special_tokens=False)[0].ids,
                np.uint32,
            )
            ends = np.searchsorted(np.cumsum(self._bytes[out]), np.cumsum([len(x) for x in group])) + 1
            ids.append(out)
            sizes.append(np.diff(ends, prepend=0))
        if not ids:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts, and the number for each text."""
        counts = np.zeros(len(offsets) - 1, np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), counts
        added = self._places(data)
        start = self._cuts(data, offsets, *added)
        end = np.append(start[1:], len(data))
        text = np.searchsorted(offsets, start, "right") - 1
        first = start == offsets[text]
        alone = first | self._apart
        for place in (added[0], added[1] - 1):
            alone[np.searchsorted(start, place, "right") - 1] = True
        hashes = span_hashes(data, start, end) ^ first.astype(np.uint64)
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        at = order[new]
        begin, size = self._look_up(ranked[new], at, alone, start, end, data)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        many = size[which]
        stop = np.cumsum(many)
        place = np.repeat(begin[which] - (stop - many), many) + np.arange(stop[-1])
        filled, rows = np.unique(text, return_index=True)
        counts[filled] = np.add.reduceat(many, rows)
        return self._pool[place], counts

    def _look_up(self, hashes, at, alone, start, end, data) -> tuple[np.ndarray, np.ndarray]:
        """Where the identifiers of each different piece lie in the pool, and
        how many; pieces of earlier batches are still there, up to a number."""
        if len(self._known) > PIECES_KEPT:
            self._forget()
        found = np.minimum(np.searchsorted(self._known, hashes), max(len(self._known) - 1, 0))
        missing = np.flatnonzero(self._known[found] != hashes) if len(self._known) else np.arange(len(hashes))
        raw = data.tobytes()
        single = alone[at[missing]]
        heads, inner = missing[single], missing[~single]
        ids, sizes = self._joined([raw[start[i]: end[i]] for i in at[inner]])
        single = [x.ids for x in self._library.encode_batch_fast(
            [raw[start[i]: end[i]].decode() for i in at[heads]], add_special_tokens=False)]
        sizes = np.concatenate([sizes, np.array([len(x) for x in single], np.int64)])
        begins = len(self._pool) + np.cumsum(sizes) - sizes
        self._pool = np.concatenate([self._pool, ids, *[np.array(x, np.uint32) for x in single]])
        known = np.concatenate([self._known, hashes[inner], hashes[heads]])
        order = np.argsort(known)
        self._known = known[order]
        self._begin = np.concatenate([self._begin, begins])[order]
        self._size = np.concatenate([self._size, sizes])[order]
        found = np.searchsorted(self._known, hashes)
        return self._begin[found], self._size[found]

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)
        self._begin = self._size = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(counts)
    return np.insert(ids, ends, end_id).astype("<u4"), counts + 1


def _write_file(files, path: str, rows: Iterator[tuple[list, np.ndarray, np.ndarray]]) -> tuple[int, int]:
    """Streams (identifiers, tokens, tokens per document) into one file and
    returns its documents and tokens."""
    identifiers, sizes, waiting, held = [], [], [], 0
    with created(files, path) as stream:
        frames = FrameWriter(stream)

        def flush():
            nonlocal waiting, held
            if held:
                frames.add(np.concatenate(waiting).tobytes())
            waiting, held = [], 0

        for ids, tokens, counts in rows:
            identifiers += ids
            sizes.append(counts)
            stops = np.cumsum(counts)
            begin = 0
            while begin < len(tokens):
                room = begin + FRAME_TOKENS - held
                stop = int(stops[min(np.searchsorted(stops, room), len(stops) - 1)])
                stop = min(stop, begin + LONGEST_FRAME)
                waiting.append(tokens[begin:stop])
                held += stop - begin
                begin = stop
                if held >= FRAME_TOKENS:
                    flush()
        flush()
        sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        known = np.array([x is not None for x in identifiers], np.uint8)
        frames.add(
            len(identifiers).to_bytes(8, "little") + known.tobytes()
            + np.array([x or 0 for x in identifiers], "<i8").tobytes()
            + np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes()
        )
        frames.finish()
    return len(identifiers), int(sizes.sum())


def write_tokens(
    documents: DataFrame, folder: str, vocabulary: str,
    id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID,
) -> DataFrame:
    """Writes the tokens of all documents in ascending order of identifier and
    returns one row per file: file, number, n_docs, n_tokens, start (the tokens
    in the files before it).

    Documents are dealt out by ranges of identifiers, null first, repeated
    identifiers in order of text; a null text counts as empty and has the end
    identifier only. Each task streams its range into one file. ``folder`` is a
    shared folder's address, ``vocabulary`` a tokenizer file on every machine.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        number = TaskContext.get().partitionId()

        def rows():
            for batch in batches:
                for piece in slices(batch, "text"):
                    ids, counts = encoder(vocabulary).encode(*flat(piece.column("text")))
                    yield (piece.column("doc_id").to_pylist(), *_with_ends(ids, counts, end_id))

        name = f"tokens-{number:06d}.zst"
        documents, tokens = _write_file(files, f"{root}/{name}", rows())
        yield pa.RecordBatch.from_pydict({
            "file": [name], "number": pa.array([number], pa.int32()), "n_docs": [documents], "n_tokens": [tokens],
        })

    parts = (
        documents.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "file string, number int, n_docs long, n_tokens long")
    )
    manifest = written(parts, "token-files")
    # One row per file, so this window is as small as the list of files.
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def documents_in(reader: FrameReader, wanted: set | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(identifier, position in the file, tokens) of the wanted documents or of
    all; only the frames that hold them are decompressed."""
    index = reader.frame(len(reader) - 1)
    count = int.from_bytes(index[:8], "little")
    known = np.frombuffer(index, np.uint8, count, 8)
    ids = np.frombuffer(index, "<i8", count, 8 + count)
    starts = np.frombuffer(index, "<i8", count + 1, 8 + 9 * count)
    edges = np.concatenate([[0], np.cumsum(reader.table["plain"][:-1].astype(np.int64) // 4)])
    last, tokens = -1, None
    for row in range(count):
        name = int(ids[row]) if known[row] else None
        if wanted is not None and name not in wanted:
            continue
        parts, at, stop = [], int(starts[row]), int(starts[row + 1])
        while at < stop:
            frame = int(np.searchsorted(edges, at, "right")) - 1
            if frame != last:
                last, tokens = frame, np.frombuffer(reader.frame(frame), "<u4")
            parts.append(tokens[at - edges[frame]: stop - edges[frame]])
            at += len(parts[-1])
        yield name, int(starts[row]), np.concatenate(parts)


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, ids (little-endian
    unsigned 32-bit integers). With ``wanted``, only those documents' frames are
    read."""
    chosen = None if wanted is None else set(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for entry in batch.to_pylist():
                with opened(files, f"{root}/{entry['file']}") as reader:
                    rows, held = [], 0
                    for name, at, tokens in documents_in(reader, chosen):
                        rows.append({"doc_id": name, "start": entry["start"] + at, "n_tokens": len(tokens), "ids": tokens.tobytes()})
                        held += len(tokens)
                        if held > FRAME_TOKENS * 8:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    each = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "start").repartition(each).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )


def checksum(ids: bytes) -> int:
    return crc32(ids)
