"""Alignment of two tokenizers' tokens by the byte offsets where both end.

Every text is encoded with a byte-level BPE (A) and with pieces (B); the ends of
each one's tokens, as byte offsets, are keys of a dictionary to the token's
index. The keys that both dictionaries have, sorted, slice the two lists of
identifiers into groups, and within a slice tokens are linked where their
bytes overlap. Identifier pairs are then counted over all documents, and each
document is given the counts of its own links.

The texts are encoded once; a written table keeps each document's linked pairs
with their number. The counts of pairs that are linked in at least one of
2^20 of all (document, pair) rows are known to all tasks: there can be no more
than 2^20 such pairs, whatever the corpus. All others come by a join.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telmart.llm import pieces
from telmart.llm.shared import binary, flat, release, slices, stored, text_of, written
from telmart.llm.tokenfiles import Encoder

# Text that a task encodes at a time, and the bytes of one pair of dictionaries.
BYTES_AT_ONCE = 2 << 20
SPAN = 1 << 13
# A pair is known to all tasks from this share of all (document, pair) rows on.
KNOWN_SHARE = 2.0 ** -20
# Different pairs that a task counts before it passes them on.
PAIRS_AT_ONCE = 1 << 19
PAIR_BITS = 32

ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
)


class PlainEncoder(Encoder):
    """The byte-level BPE with the strings of added tokens as plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self._library.encode_special_tokens = True
        self._added, self._apart = [], False
        # How a byte-level vocabulary writes bytes: printable ones as they are, the others from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [x for x in range(256) if x not in set(plain)]
        of_char = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(other)}
        size = self._library.get_vocab_size()
        names = [self._library.id_to_token(i) or "" for i in range(size)]
        self.surface = Surface([bytes(of_char.get(c, 0) for c in name) for name in names])


class Surface:
    """The bytes that each identifier stands for."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(x) for x in texts], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def spread(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All identifiers' bytes, and where each identifier's end."""
        size = self.size[ids]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        return self.data[np.repeat(self.at[ids] - (stop - size), size) + np.arange(total)], stop


class Aligner:
    def __init__(self, bytes_path: str, pieces_path: str):
        import sentencepiece

        self.a, self.b = PlainEncoder(bytes_path), pieces.Pieces(pieces_path)
        library = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        names = [library.id_to_piece(i) for i in range(library.vocab_size())]
        self.b_surface = Surface([
            bytes([int(name[3:5], 16)]) if library.is_byte(i) else name.replace(pieces.BLANK, " ").encode()
            for i, name in enumerate(names)
        ])
        most = max(len(names), len(self.a.surface.size))
        self.digits = Surface([b"%d," % i for i in range(most)])

    def align(self, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        """ALIGNED for texts, given as bytes and offsets."""
        texts = len(offsets) - 1
        size = np.diff(offsets)
        filled = np.flatnonzero(size)
        spaced = np.insert(data, offsets[filled], 32)
        bounds = np.concatenate([[0], np.cumsum(size + (size > 0))])
        a_ids, a_counts = self.a.encode(spaced, bounds)
        b_ids, b_counts = self.b.encode(data, offsets)
        inner = np.ones(len(b_ids), bool)
        stop = np.cumsum(b_counts)
        inner[stop - b_counts] = inner[stop - 1] = False
        b_ids, b_counts = b_ids[inner], b_counts - 2
        same = self._spells(self.a.surface, a_ids, a_counts, spaced, bounds)
        same &= self._spells(self.b_surface, b_ids, b_counts, spaced, bounds)
        same &= size > 0
        a_ids, a_counts = a_ids[np.repeat(same, a_counts)].astype(np.int64), np.where(same, a_counts, 0)
        b_ids, b_counts = b_ids[np.repeat(same, b_counts)].astype(np.int64), np.where(same, b_counts, 0)
        a_end, b_end = np.cumsum(self.a.surface.size[a_ids]), np.cumsum(self.b_surface.size[b_ids])
        a_cut, b_cut = self._shared(a_end, b_end)
        hashes, n_groups = self._groups(a_ids, b_ids, a_cut, b_cut, a_counts)
        text = np.repeat(np.arange(texts), a_counts)
        pairs, times, n_links, n_pairs = self._links(a_ids, b_ids, a_end, b_end, text, texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a_counts, pa.int64()), pa.array(b_counts, pa.int64()), pa.array(n_groups, pa.int64()),
                pa.array(n_links, pa.int64()), pa.array(hashes, pa.string()),
                binary(pairs.astype("<u4"), n_pairs), binary(times.astype("<u4"), n_pairs),
            ],
            [field.split()[0] for field in ALIGNED.split(", ")],
        )

    @staticmethod
    def _spells(surface: Surface, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Of each text, whether its identifiers' bytes make up the text."""
        spelled, _ = surface.spread(ids)
        if len(spelled) == len(data) and (spelled == data).all():
            owner = np.repeat(np.arange(len(counts)), counts)
            length = np.bincount(owner, surface.size[ids], len(counts)).astype(np.int64)
            if (length == np.diff(bounds)).all():
                return np.ones(len(counts), bool)
        owner = np.repeat(np.arange(len(counts)), counts)
        stop = np.cumsum(np.bincount(owner, surface.size[ids], len(counts)).astype(np.int64))
        begin = np.concatenate([[0], stop[:-1]])
        raw, own = data.tobytes(), spelled.tobytes()
        return np.array([own[s:e] == raw[a:b] for s, e, a, b in zip(begin, stop, bounds[:-1], bounds[1:])], bool)

    @staticmethod
    def _shared(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """After how many tokens of each side the groups end. The dictionaries
        hold the ends of a stretch of bytes at a time; no end is in two."""
        a_cut, b_cut = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        total = int(a_end[-1]) if len(a_end) else 0
        edges = np.arange(0, total + SPAN, SPAN)
        a_at, b_at = np.searchsorted(a_end, edges, "right"), np.searchsorted(b_end, edges, "right")
        for a0, a1, b0, b1 in zip(a_at[:-1], a_at[1:], b_at[:-1], b_at[1:]):
            a_ends, b_ends = a_end[a0:a1].tolist(), b_end[b0:b1].tolist()
            a_index, b_index = dict(zip(a_ends, range(a0 + 1, a1 + 1))), dict(zip(b_ends, range(b0 + 1, b1 + 1)))
            # Ends rise, so those that are found come sorted.
            common = list(filter(b_index.__contains__, a_ends))
            a_cut.append(np.array([a_index[end] for end in common], np.int64))
            b_cut.append(np.array([b_index[end] for end in common], np.int64))
        return np.concatenate(a_cut), np.concatenate(b_cut)

    def _groups(self, a_ids, b_ids, a_cut, b_cut, a_counts) -> tuple[list[str], np.ndarray]:
        """Each text's hash of its groups in writing, and their number. A text
        ends with a group, as both sides spell it to its end."""
        before = np.concatenate([[0], np.cumsum(a_counts)])
        first = np.searchsorted(a_cut, before, "left")
        first = np.where(before == 0, 0, first + 1)
        n_groups = np.where(a_counts > 0, np.diff(first), 0)
        # Slices stand one after the other: A's tokens, then B's.
        a_place = np.arange(len(a_ids)) + np.concatenate([[0], b_cut])[_group_of(a_cut, len(a_ids))]
        b_place = np.arange(len(b_ids)) + np.concatenate([a_cut, [0]])[_group_of(b_cut, len(b_ids))]
        ids = np.empty(len(a_ids) + len(b_ids), np.int64)
        ids[a_place], ids[b_place] = a_ids, b_ids
        written_out, stop = self.digits.spread(ids)
        a_last, b_last = a_place[a_cut - 1], b_place[b_cut - 1]
        written_out[stop[a_last] - 1] = ord("|")
        written_out[stop[b_last] - 1] = ord(";")
        data, hashes, begin = written_out.tobytes(), [], 0
        ends = np.concatenate([[0], stop[b_last]])[first]
        for filled, end in zip((a_counts > 0).tolist(), ends[1:].tolist()):
            hashes.append(hashlib.sha256(data[begin: end - 1]).hexdigest() if filled else "")
            begin = end if filled else begin
        return hashes, n_groups

    @staticmethod
    def _links(a_ids, b_ids, a_end, b_end, text, texts):
        """The different linked pairs of each text in order, how often each is
        linked, and the numbers of links and of pairs of each text. Between
        two neighbouring ends of either side lies one link."""
        ends = np.concatenate([a_end, b_end])
        order = np.argsort(ends, kind="stable")
        ends, from_a = ends[order], order < len(a_end)
        last = np.append(ends[1:] != ends[:-1], True)[: len(ends)]
        # Where both sides end, A's end stands before B's.
        both = np.append(False, ~last[:-1])[: len(ends)][last]
        a_before, b_before = np.cumsum(from_a)[last], np.cumsum(~from_a)[last]
        at = a_before - (from_a[last] | both)
        keys = (text[at] << PAIR_BITS) | (a_ids[at] << 16) | b_ids[b_before - ~from_a[last]]
        n_links = np.bincount(text[at], minlength=texts)
        keys, times = np.unique(keys, return_counts=True)
        n_pairs = np.bincount(keys >> PAIR_BITS, minlength=texts)
        return keys & ((1 << PAIR_BITS) - 1), times, n_links, n_pairs


def _group_of(cuts: np.ndarray, count: int) -> np.ndarray:
    """Each token's group, where groups end after ``cuts`` tokens."""
    marks = np.zeros(count + 1, np.int64)
    marks[cuts] = 1
    return np.cumsum(marks)[:count]


@lru_cache(maxsize=2)
def aligner(bytes_path: str, pieces_path: str) -> Aligner:
    return Aligner(bytes_path, pieces_path)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    return np.frombuffer(data.tobytes(), "<u4").astype(np.int64), np.diff(offsets) // 4


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair, n: in how many of some documents each pair is linked."""
    def counted() -> pa.RecordBatch:
        pairs, inverse = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([x for _, x in held]), len(pairs)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for part in slices(batch, "pairs"):
            held.append(np.unique(_numbers(part.column("pairs"))[0], return_counts=True))
            if sum(len(x) for x, _ in held) > 4 * PAIRS_AT_ONCE:
                merged = counted()
                if merged.num_rows > PAIRS_AT_ONCE:
                    yield merged
                    held = []
                else:
                    held = [(merged.column("pair").to_numpy(), merged.column("n").to_numpy())]
    if held:
        yield counted()


def _known_sums(known):
    """Each document's sums over the links of the known pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_pairs, known_n, known_best = known.value
        for batch in batches:
            for part in slices(batch, "pairs"):
                pairs, counts = _numbers(part.column("pairs"))
                times = _numbers(part.column("times"))[0]
                at, hit = _find(known_pairs, pairs)
                owner = np.repeat(np.arange(len(counts)), counts)[hit]
                n, best, times = known_n[at[hit]], known_best[at[hit]], times[hit]
                total, links = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
                np.add.at(total, owner, n * times)
                np.add.at(links, owner, best * times)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in part.schema.names if x not in ("pairs", "times")), pa.array(links), pa.array(total)],
                    [*(x for x in part.schema.names if x not in ("pairs", "times")), "known_best", "known_sum"],
                )

    return run


def _rare_links(known):
    """row, pair, times of the links of all other pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "pairs"):
                pairs, counts = _numbers(part.column("pairs"))
                rare = np.flatnonzero(~_find(known.value[0], pairs)[1])
                row = np.repeat(part.column("row").to_numpy(), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[rare]), pa.array(pairs[rare]), pa.array(_numbers(part.column("times"))[0][rare])], ["row", "pair", "times"]
                )

    return run


def _find(known: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
    return at, known[at] == pairs


def aligned_tokens(
    documents: DataFrame, bytes_path: str, pieces_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a blank and the text, B the text, to which it adds the blank. A
    text that is null or empty, or that either side's tokens do not spell byte
    for byte, has no tokens: zeros, and an empty hash. Rows stay as they are,
    repeated or null identifiers too, and repeated rows count as documents of
    their own; other columns are ignored. The files are on every machine.
    """
    spark = documents.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = aligner(bytes_path, pieces_path)
        for batch in batches:
            for part in slices(batch, "text", BYTES_AT_ONCE):
                found = coder.align(*flat(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), *found.columns], ["doc_id", "row", *found.schema.names]
                )

    rows = documents.select(
        F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    encoded, encoded_folder = stored(
        rows.mapInArrow(run, f"doc_id {kind}, row long, {ALIGNED}"), "aligned", compression="zstd"
    )
    tallied = encoded.select("pairs").mapInArrow(_tally, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    tallied, tallied_folder = stored(tallied.withColumn("a", F.shiftright("pair", 16)), "pair-tally")
    most = tallied.groupBy("a").agg(F.max("n").alias("most"))
    counts, counts_folder = stored(
        tallied.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts"
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_known = F.col("n") >= max(1.0, total * KNOWN_SHARE)
    table = counts.where(is_known).toArrow().combine_chunks().sort_by("pair")
    known = spark.sparkContext.broadcast((
        table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy().astype(np.int64)
    ))
    rare = encoded.select("row", "pairs", "times").mapInArrow(_rare_links(known), "row long, pair long, times long")
    rare_sums = rare.join(counts.where(~is_known), "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("rare_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("rare_best")
    )
    narrow = [f.name for f in encoded.schema if f.name not in ("pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema if f.name in narrow)
    sums = encoded.mapInArrow(_known_sums(known), f"{schema}, known_best long, known_sum long")
    result = written(
        sums.join(rare_sums, "row", "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            (F.col("known_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
            (F.col("known_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
            "groups_sha256",
        ),
        "aligned-documents",
    )
    known.unpersist()
    release(spark, encoded_folder, tallied_folder, counts_folder)
    return result
