"""An n-gram language model with Katz backoff, trained and applied on Spark.

P(w | h) is the discounted relative frequency of the pair where training has
it; else the history's backoff weight times P(w), which in turn is the word's
discounted relative frequency or, for a word that training lacks, the mass that
the discounts leave (all such words are one class, as in the base model).
Counts up to KATZ_LIMIT are discounted by Good-Turing. A history's weight is
its left-over mass divided by the mass of P(w) over the words not seen after
it, so that each history's probabilities add up to one.

Higher orders go on in the same way: P(w | more, h) is discounted where training
has the longer n-gram, else the longer history's weight times P(w | h). A block
holds all n-grams that end with its pairs, so every order is evaluated there; the
sums of longer histories whose last word lies in several blocks are added up in
a table.

Two passes over the texts: word counts; the documents' own figures and their
tokens as ranks of frequent words and hashes of rare ones. These codes are what
is read from then on: the rare words, whose counts come by a join, and the pairs.
Pairs are dealt out by
history, a frequent history by history and word, to blocks that hold their
counts, the counts of their words, and the documents that they occur in. The
blocks are the model's partitioned table, and every token is evaluated in the
block of its history. Words with a certain share of all tokens are known to all
tasks, which bounds their number and changes no result.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from telmart.llm.packing import pack, smallest, steps, unpack
from telmart.llm.shared import binary, flat, numbered_in, release, remainder, slices, stored, written
from telmart.llm.shingles import mix, words

KATZ_LIMIT = 5
# Every task knows the counts of words that are at least one of so many tokens;
# there are at most so many of them, some 20 bytes each.
KNOWN_EVERYWHERE = 1 << 22
# Tokens that a task holds before it deals them out.
TOKENS_AT_ONCE = 1 << 20
# Text that a task takes apart at a time.
BYTES_AT_ONCE = 2 << 20
# Stored codes that a task works on at a time, four bytes a token.
CODES_AT_ONCE = 1 << 20
# Tokens of a block whose longer n-grams are sorted at a time.
SORTED_AT_ONCE = 1 << 18
BLOCKS_PER_PARTITION = 4
# A history stays in one block up to so many times a block's share of the tokens,
# less than a partition's share; of longer ones each block gets at most as much.
SHARES_OF_A_HISTORY = 3
# The blocks are built in so many waves, each from its own pass over the codes
# that deals out its own pairs only, and evaluated in these waves again, so that
# the shuffle files of one are gone when the next begins.
WAVES = 2
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
# Marks a word that is given by its hash, not by its rank.
BY_HASH = np.uint64(1 << 63)


def discounts(with_count: np.ndarray, limit: int = KATZ_LIMIT) -> np.ndarray:
    """The discount of each count from 0 to ``limit``. ``with_count[r]`` is the
    number of n-grams that occur r times, up to limit + 1. Where the figures
    allow no discount between 0 and 1, there is none."""
    out = np.ones(limit + 1)
    if with_count[1] == 0:
        return out
    common = (limit + 1) * with_count[limit + 1] / with_count[1]
    for r in range(1, limit + 1):
        if common < 1 and with_count[r]:
            value = ((r + 1) * with_count[r + 1] / (r * with_count[r]) - common) / (1 - common)
            if 0 < value < 1:
                out[r] = value
    return out


def discounted(count: np.ndarray, by: np.ndarray) -> np.ndarray:
    return count * by[np.where(count < len(by), count, 0)] if len(count) else count.astype(float)


def left_over(total: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and free mass of counts that add up to ``total`` and to
    ``used`` after discounts. Without any discount one more event is assumed,
    so that some mass is always free."""
    tight = used >= total - 1e-9
    below = np.where(tight, total + 1, total)
    return below, (below - used) / np.maximum(below, 1)


@dataclass
class Unigrams:
    """Training totals, unigram discounts and the frequent words."""

    tokens: int
    types: int
    discount: np.ndarray
    denominator: float
    unknown: float
    hashes: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each frequent word, -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        # About one word begins with each value of the leading bits: the search
        # starts at the first one that does, and hardly goes on.
        shift, first = self._leading
        at, last = first[hashes >> shift], len(self.hashes) - 1
        on = np.flatnonzero((self.hashes[at] < hashes) & (at < last))
        while len(on):
            at[on] += 1
            on = on[(self.hashes[at[on]] < hashes[on]) & (at[on] < last)]
        return np.where(self.hashes[at] == hashes, self.ranks[at], -1)

    @cached_property
    def _leading(self) -> tuple[np.uint64, np.ndarray]:
        """By how much to shift a hash for its leading bits, and for each value
        of these the first word that is not below it."""
        bits = len(self.hashes).bit_length()
        shift = np.uint64(64 - bits)
        first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << shift)
        return shift, np.minimum(first, len(self.hashes) - 1).astype(np.int32)

    @cached_property
    def by_rank(self) -> np.ndarray:
        """Hashes of the frequent words in order of their ranks."""
        out = np.empty(len(self.hashes), np.uint64)
        out[self.ranks] = self.hashes
        return out

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Frequent words by rank, others by hash."""
        rank = self.find(hashes)
        return np.where(rank >= 0, rank.astype(np.uint64), hashes | BY_HASH)

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(count, self.discount) / max(self.denominator, 1), self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def _tokens(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of the token before each, and the tokens before
    each document."""
    data, offsets = flat(piece.column("text"))
    _, _, hashes, bounds = words(data, offsets)
    token = np.insert(hashes, bounds[1:], END)
    history = np.insert(hashes, bounds[:-1], START)
    return token, history, bounds + np.arange(len(bounds))


def _shifted(values: np.ndarray, bounds: np.ndarray, start: np.uint64, times: int) -> list[np.ndarray]:
    """What stands before each token's history, word by word."""
    out = []
    for _ in range(times):
        values = np.concatenate([values[:0], [start], values[:-1]]).astype(np.uint64)
        values[bounds[:-1]] = start
        out.append(values)
    return out


def _rows(documents: DataFrame) -> tuple[DataFrame, str]:
    """doc_id, text, row and held_out, numbered once for all passes, and the
    folder that has them."""
    rows, folder = numbered_in(documents)
    return rows.withColumn("held_out", remainder(F.col("doc_id"), 10) == 0), folder


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values = np.concatenate([x for x, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    order = np.argsort(values)
    values = values[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def count_words(texts: DataFrame, blocks: int) -> DataFrame:
    """Training counts: w (hash), n."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def deal():
            values, counts = _counted(parts)
            block = (mix(values) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            edges = np.searchsorted(block[order], np.arange(blocks + 1))
            rows = [b for b in range(blocks) if edges[b + 1] > edges[b]]
            yield _batch(
                block=pa.array(rows, pa.int32()),
                payload=pa.array([
                    pack(steps(values[order[edges[b]: edges[b + 1]]]), smallest(counts[order[edges[b]: edges[b + 1]]]))
                    for b in rows
                ], pa.binary()),
            )

        for batch in batches:
            for piece in slices(batch, "text", BYTES_AT_ONCE):
                token, _, bounds = _tokens(piece)
                train = np.repeat(~piece.column("held_out").to_numpy(zero_copy_only=False), np.diff(bounds))
                parts.append(_counted([(token[train], np.ones(int(train.sum()), np.int64))]))
                held += len(parts[-1][0])
                if held > TOKENS_AT_ONCE:
                    yield from deal()
                    parts, held = [], 0
        if parts:
            yield from deal()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, payloads in _by_block(batches):
            parts = [unpack(x) for x in payloads]
            values, counts = _counted([(np.cumsum(w, dtype=np.uint64), n.astype(np.int64)) for w, n in parts])
            yield _batch(w=pa.array(values.view(np.int64)), n=pa.array(counts))

    dealt = texts.mapInArrow(local, "block int, payload binary")
    return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "w long, n long")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Payloads of one block after the other, from rows sorted by block."""
    now, held = None, []
    for batch in batches:
        for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if block != now:
                if held:
                    yield now, held
                now, held = block, []
            held.append(payload)
    if held:
        yield now, held


def unigram_model(counts: DataFrame) -> Unigrams:
    """Totals, discounts and the frequent words of a table (w, n)."""
    top = 1 << 16
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # At most ``top`` rows.
    table = counts.groupBy(F.least("n", F.lit(top)).alias("n")).agg(F.count("*").alias("words")).collect()
    with_count = np.zeros(top + 1, np.int64)
    for row in table:
        with_count[row["n"]] = row["words"]
    by = discounts(with_count)
    used = tokens - sum(with_count[r] * r * (1 - by[r]) for r in range(1, KATZ_LIMIT + 1))
    below, free = left_over(np.array([float(tokens)]), np.array([float(used)]))
    least = -(-int(tokens) // KNOWN_EVERYWHERE) if KNOWN_EVERYWHERE else int(tokens) + 1
    # No more than KNOWN_EVERYWHERE words can have that share of the tokens.
    known = counts.where(F.col("n") >= least).toArrow()
    hashes = known.column("w").to_numpy().view(np.uint64)
    count = known.column("n").to_numpy()
    rank = np.lexsort((hashes, -count))
    ranks = np.empty(len(rank), np.int64)
    ranks[rank] = np.arange(len(rank))
    order = np.argsort(hashes)
    return Unigrams(
        int(tokens), int(types), by, float(below[0]), float(free[0]) if tokens else 1.0,
        hashes[order], ranks[order].astype(np.int32), count[rank],
    )


def _own_figures(texts: DataFrame, shared) -> DataFrame:
    """Per row: its number of tokens, what the frequent words add to the base
    score, and its tokens: each one's rank plus one, zero for the rare, whose
    hashes follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in slices(batch, "text", BYTES_AT_ONCE):
                token, _, bounds = _tokens(piece)
                rank = model.find(token)
                known = rank >= 0
                score = np.zeros(len(token))
                score[known] = model.base(model.counts[rank[known]])
                rare = np.flatnonzero(~known)
                edges = np.searchsorted(rare, bounds)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("row"), piece.column("held_out"),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(np.add.reduceat(known.astype(np.int64), bounds[:-1]), pa.int64()),
                    pa.array(np.add.reduceat(score, bounds[:-1])),
                    binary((rank + 1).astype("<u4"), np.diff(bounds)), binary(token[rare].astype("<u8"), np.diff(edges)),
                ], ["doc_id", "row", "held_out", "n_tokens", "n_known", "base_score", "codes", "rare"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"doc_id {kind}, row long, held_out boolean, n_tokens long, n_known long, base_score double, codes binary, rare binary"
    )


def _stored_tokens(piece: pa.RecordBatch, model: Unigrams):
    """As ``_tokens``, from the stored codes; before the rest the tokens' ranks,
    -1 for the rare."""
    codes, offsets = flat(piece.column("codes"))
    rank = np.frombuffer(codes.tobytes(), "<u4").astype(np.int64) - 1
    bounds, rare = offsets // 4, rank < 0
    token = np.empty(len(rank), np.uint64)
    token[~rare] = model.by_rank[rank[~rare]]
    token[rare] = np.frombuffer(flat(piece.column("rare"))[0].tobytes(), "<u8")
    return rank, token, _shifted(token, bounds, START, 1)[0], bounds


def _rare_pairs(own: DataFrame, counts: DataFrame, shared, order: int) -> DataFrame:
    """row, held_out, h, w, the words before h as e0 and so on, n (the word's
    training count, 0 if it has none)."""
    names = ["h", "w", *(f"e{j}" for j in range(order - 2))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in slices(batch, "codes", CODES_AT_ONCE):
                rank, token, history, bounds = _stored_tokens(piece, model)
                rare = np.flatnonzero(rank < 0)
                at = np.repeat(np.arange(piece.num_rows), np.diff(np.searchsorted(rare, bounds)))
                columns = (history, token, *_shifted(history, bounds, START, order - 2))
                yield pa.RecordBatch.from_arrays([
                    piece.column("row").take(pa.array(at)), piece.column("held_out").take(pa.array(at)),
                    *(pa.array(x[rare].view(np.int64)) for x in columns),
                ], ["row", "held_out", *names])

    pairs = own.where("length(rare) > 0").select("row", "held_out", "codes", "rare").mapInArrow(
        run, "row long, held_out boolean, " + ", ".join(f"{x} long" for x in names)
    )
    return pairs.join(counts, "w", "left").select("row", "held_out", *names, F.coalesce("n", F.lit(0)).alias("n"))


def _figures(own: DataFrame, rare: DataFrame, model: Unigrams) -> DataFrame:
    """doc_id, row, held_out, n_tokens, n_known, base_score of every row, rare
    words included: what is needed of the figures to the end."""
    smooth = F.log10((F.col("n") + 0.1) / F.lit(model.tokens + 0.1 * (model.types + 1)))
    rest = rare.groupBy("row").agg(
        F.sum((F.col("n") > 0).cast("long")).alias("rare_known"), F.sum(smooth).alias("rare_base")
    )
    return own.drop("codes", "rare").join(rest, "row", "left").select(
        "doc_id", "row", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
    )


class _Dealer:
    """Which block a pair belongs to: that of its history, or one of several
    for a history with more than SHARES_OF_A_HISTORY blocks' share of the tokens.
    Each split costs the exchange of the sums of its longer histories."""

    def __init__(self, model: Unigrams, blocks: int):
        self.blocks = blocks
        share = max(SHARES_OF_A_HISTORY * model.tokens / blocks, 1)
        order = np.argsort(model.ranks)
        hot = order[: int(np.searchsorted(-model.counts, -share, "right"))]
        hashes = model.hashes[hot]
        parts = np.ceil(model.counts[: len(hot)] / share).astype(np.uint64)
        # Each document starts once, so the start is as frequent as the end.
        ends = model.find(np.array([END]))[0]
        started = int(model.counts[ends]) if ends >= 0 else 0
        hashes = np.append(hashes, START)
        parts = np.append(parts, np.uint64(max(int(np.ceil(started / share)), 1)))
        sort = np.argsort(hashes)
        self.hot, self.parts = hashes[sort], parts[sort]

    def split(self, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hot, history), len(self.hot) - 1)
        return np.flatnonzero((self.hot[at] == history) & (self.parts[at] > 1)), at

    def block(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = mix(history)
        hot, at = self.split(history)
        out[hot] = out[hot] % np.uint64(self.blocks) + mix(word[hot] ^ START) % self.parts[at[hot]]
        return (out % np.uint64(self.blocks)).astype(np.int64)


def _deal(dealer: _Dealer, block, history, word, count, place, *earlier) -> pa.RecordBatch:
    """Occurrences packed by block. ``word`` is a rank, or a hash with its
    training count; ``place`` is the row number times two, plus one if it is
    held out; ``earlier`` are the codes of the words before the history."""
    order = np.argsort(history)
    block = block[order]
    by_block = np.argsort(smallest(block), kind="stable")
    block, order = block[by_block], order[by_block]
    history, word, count, place = history[order], word[order], count[order], place[order]
    earlier = [x[order] for x in earlier]
    edges = np.searchsorted(block, np.arange(dealer.blocks + 1))
    rows = [b for b in range(dealer.blocks) if edges[b + 1] > edges[b]]
    packed = []
    for b in rows:
        part = slice(edges[b], edges[b + 1])
        h, w, n, at = history[part], word[part], count[part], place[part]
        new = np.append(True, h[1:] != h[:-1])
        hashed = w >= BY_HASH
        least = at.min()
        packed.append(pack(
            steps(h[new]), smallest(np.diff(np.append(np.flatnonzero(new), len(h)))),
            smallest(np.where(hashed, 0, w + np.uint64(1))), w[hashed], smallest(n[hashed]),
            np.array([least]), smallest(at - least), *_coded(x[part] for x in earlier),
        ))
    return _batch(block=pa.array(rows, pa.int32()), payload=pa.array(packed, pa.binary()))


def _coded(columns) -> Iterator[np.ndarray]:
    """Each column of word codes as ranks plus one, zero for the hashes behind."""
    for code in columns:
        hashed = code >= BY_HASH
        yield smallest(np.where(hashed, 0, code + np.uint64(1)))
        yield code[hashed]


def _decoded(arrays: list[np.ndarray]) -> list[np.ndarray]:
    out = []
    for ranked, hashed in zip(arrays[::2], arrays[1::2]):
        code = ranked.astype(np.uint64) - np.uint64(1)
        code[ranked == 0] = hashed
        out.append(code)
    return out


def _dealt(payloads: list[bytes], counts: np.ndarray):
    """The occurrences of a block: history, word, the word's count, place, and
    the words before the history."""
    out = []
    for payload in payloads:
        h, many, ranked, hashed, n, least, at, *earlier = unpack(payload)
        word = ranked.astype(np.uint64) - np.uint64(1)
        by_hash = ranked == 0
        word[by_hash] = hashed
        count = np.zeros(len(word), np.int64)
        count[~by_hash] = counts[word[~by_hash].astype(np.int64)]
        count[by_hash] = n
        out.append((
            np.repeat(np.cumsum(h, dtype=np.uint64), many), word, count, at.astype(np.int64) + least[0], *_decoded(earlier),
        ))
    return [np.concatenate(x) for x in zip(*out)]


def _pairs(own: DataFrame, rare: DataFrame, shared, blocks: int, order: int, wave: int = 0, waves: int = 1) -> DataFrame:
    """Every token with its history, packed by block: block, payload; only of
    the blocks of one wave."""
    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, dealer = shared.value, _Dealer(shared.value, blocks)
        parts, held = [], 0
        for batch in batches:
            for piece in slices(batch, "codes", CODES_AT_ONCE):
                rank, token, history, bounds = _stored_tokens(piece, model)
                place = piece.column("row").to_numpy() * 2 + piece.column("held_out").to_numpy(zero_copy_only=False)
                known = np.flatnonzero(rank >= 0)
                block = dealer.block(history[known], rank[known].astype(np.uint64))
                chosen = np.flatnonzero(block % waves == wave)
                known, block = known[chosen], block[chosen]
                codes = np.where(rank >= 0, rank.astype(np.uint64), token | BY_HASH)
                earlier = _shifted(codes, bounds, START | BY_HASH, order - 1)[1:]
                parts.append((
                    block, history[known], rank[known].astype(np.uint64), np.zeros(len(known), np.uint8),
                    np.repeat(place, np.diff(bounds))[known], *(x[known] for x in earlier),
                ))
                held += len(known)
                if held > TOKENS_AT_ONCE:
                    yield _deal(dealer, *[np.concatenate(x) for x in zip(*parts)])
                    parts, held = [], 0
        if held:
            yield _deal(dealer, *[np.concatenate(x) for x in zip(*parts)])

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, dealer = shared.value, _Dealer(shared.value, blocks)
        waiting, held = [], 0
        for batch in batches:
            history, word = (batch.column(name).to_numpy().view(np.uint64) for name in ("h", "w"))
            block = dealer.block(history, word | BY_HASH)
            chosen = np.flatnonzero(block % waves == wave)
            waiting.append((block[chosen], batch.take(pa.array(chosen))))
            held += len(chosen)
            if held > TOKENS_AT_ONCE // 4:
                yield _deal(dealer, *_unrolled(waiting, model, order))
                waiting, held = [], 0
        if held:
            yield _deal(dealer, *_unrolled(waiting, model, order))

    coded = own.select("row", "held_out", "codes", "rare")
    return coded.mapInArrow(frequent, "block int, payload binary").unionByName(
        rare.mapInArrow(other, "block int, payload binary")
    )


def _unrolled(parts: list[tuple[np.ndarray, pa.RecordBatch]], model: Unigrams, order: int):
    rows = pa.Table.from_batches([batch for _, batch in parts])
    number = {name: rows.column(name).to_numpy() for name in ("row", "h", "w", "n", "held_out")}
    return (
        np.concatenate([block for block, _ in parts]), number["h"].view(np.uint64), number["w"].view(np.uint64) | BY_HASH, number["n"],
        number["row"] * 2 + number["held_out"].astype(np.int64),
        *(model.codes(rows.column(f"e{j}").to_numpy().view(np.uint64)) for j in range(order - 2)),
    )


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted columns begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def build_blocks(pairs: DataFrame, shared, blocks: int) -> DataFrame:
    """The model's table: for each block the pairs with their training counts
    and words' counts, the documents of each, how many pairs have each small
    count, the sums of histories that lie in several blocks, and whether it has
    any of these (hot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, dealer = shared.value, _Dealer(shared.value, blocks)
        for block, payloads in _by_block(batches):
            history, word, count, place, *earlier = _dealt(payloads, model.counts)
            order, first = _alike(history, word)
            size = np.diff(np.append(first, len(word)))
            trained = np.add.reduceat(1 - (place[order] & 1), first)
            with_count = [_with_count(trained)]
            # Pairs in order of their history, and their occurrences with them.
            pair = np.argsort(history[order[first]], kind="stable")
            first, size, trained = first[pair], size[pair], trained[pair]
            h, w, n = (x[order[first]] for x in (history, word, count))
            stop = np.cumsum(size)
            order = order[np.repeat(first - (stop - size), size) + np.arange(len(order))]
            # Longer n-grams side by side below their pair.
            number = np.repeat(np.arange(len(size)), size)
            earlier = [x[order] for x in earlier]
            if earlier:
                sort = _sorted_within(number, earlier)
                order, earlier = order[sort], [x[sort] for x in earlier]
            place = place[order]
            longer = []
            for upto in range(1, len(earlier) + 1):
                grams = _groups(number, *earlier[:upto])
                own = np.add.reduceat(1 - (place & 1), grams)
                with_count.append(_with_count(own))
                if upto == len(earlier):
                    longer = [
                        smallest(np.bincount(number[grams], minlength=len(w))), smallest(own),
                        smallest(np.diff(np.append(grams, len(place)))), *_coded(x[grams] for x in earlier),
                    ]
            # Histories in several blocks: totals by count, and the words' mass.
            groups = _groups(h)
            hot = groups[dealer.split(h[groups])[0]]
            sums = _history_sums(model, h, n, trained, groups)
            chosen = np.isin(groups, hot)
            hashed = w >= BY_HASH
            least = place.min()
            yield _batch(
                block=pa.array([block], pa.int32()), with_count=pa.array([[x.tolist() for x in with_count]], pa.list_(pa.list_(pa.int64()))),
                split=pa.array([pack(h[groups[chosen]], *[x[chosen] for x in sums])], pa.binary()), hot=pa.array([bool(chosen.any())]),
                payload=pa.array([pack(
                    steps(h[groups]), smallest(np.diff(np.append(groups, len(h)))),
                    smallest(np.where(hashed, 0, w + np.uint64(1))), w[hashed], smallest(n[hashed]),
                    smallest(trained), smallest(size), np.array([least]), smallest(place - least), *longer,
                )], pa.binary()),
            )

    return pairs.repartition("block").sortWithinPartitions("block").mapInArrow(
        run, "block int, with_count array<array<long>>, split binary, hot boolean, payload binary"
    )


def _sorted_within(number: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    """An order that puts equal combinations of codes side by side within equal,
    ascending numbers without gaps; whole numbers of some SORTED_AT_ONCE at a time."""
    out, start = np.empty(len(number), np.int64), 0
    while start < len(number):
        stop = min(start + SORTED_AT_ONCE, len(number))
        part = slice(start, int(np.searchsorted(number, number[stop - 1], "right")))
        out[part] = start + _sorted_part(number[part] - number[start], [x[part] for x in codes])
        start = part.stop
    return out


def _sorted_part(number: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    if len(codes) == 1 and number[-1] < 1 << 24:
        key = (number.astype(np.uint64) << np.uint64(40)) | (mix(codes[0]) >> np.uint64(24))
        order = np.argsort(key)
        if len(_groups(key[order])) == len(_groups(number, codes[0][order])):
            return order
    # Several codes, or two of a number with one key.
    return np.lexsort((*reversed(codes), number))


def _with_count(trained: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(trained, KATZ_LIMIT + 2), minlength=KATZ_LIMIT + 3)


def _alike(history: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal pairs side by side, and where each begins."""
    key = mix(history ^ mix(word))
    order = np.argsort(key)
    key, history, word = key[order], history[order], word[order]
    first = _groups(history, word)
    if len(first) == len(_groups(key)):
        return order, first
    # Two pairs with one key.
    again = np.lexsort((word, history))
    return order[again], _groups(history[again], word[again])


def _history_sums(model: Unigrams, h, n, trained, groups):
    """Per history: training tokens, tokens by small count (one column each),
    and the mass of P(w) of the words seen after it."""
    seen = trained > 0
    mass = np.add.reduceat(np.where(seen, model.probability(n), 0.0), groups)
    small = [np.add.reduceat(np.where(trained == r, r, 0), groups) for r in range(1, KATZ_LIMIT + 1)]
    return [np.add.reduceat(trained, groups), *small, mass]


def evaluate(waves: list[DataFrame], folders: list[str], shared, order: int) -> DataFrame:
    """row, score, tokens: the summed log10 probabilities of a row's tokens.
    The waves of blocks are joined with their sums one after the other, and the
    folder of each is removed with it."""
    blocks = reduce(DataFrame.unionByName, waves)
    spark = blocks.sparkSession
    each = blocks.select(F.posexplode("with_count").alias("k", "c")).select("k", F.posexplode("c").alias("r", "n"))
    with_count = np.zeros((order - 1, KATZ_LIMIT + 3), np.int64)
    # A few figures an order.
    for k, r, n in each.groupBy("k", "r").agg(F.sum("n")).collect():
        with_count[k, r] = n
    by = [discounts(x) for x in with_count]
    # At most two entries a block: a history is split by its share of the tokens.
    split: dict[int, np.ndarray] = {}
    for row in blocks.select("split").toLocalIterator():
        h, *sums = unpack(bytes(row[0]))
        for key, values in zip(h.tolist(), np.array(sums, float).T):
            split[key] = split.get(key, 0) + values
    across = spark.sparkContext.broadcast((by, split))
    # Blocks without such histories need no sums of others: only the rest are shuffled.
    alone = [wave.where("NOT hot") for wave in waves]
    waves, tables = [wave.where("hot") for wave in waves], []
    for k in range(3, order + 1):
        alone = [wave.withColumn(f"sums{k}", F.lit(None).cast(SUMS_TYPE)) for wave in alone]
        waves, folder = _with_sums(waves, shared, across, k)
        tables.append(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        by, split = across.value
        for batch in batches:
            for i in range(batch.num_rows):
                place, score = _evaluated(model, by, split, *_block(batch, i, order))
                row = place >> 1
                by_row = np.argsort(row)
                row, score = row[by_row], score[by_row]
                first = _groups(row)
                total = np.add.reduceat(score, first)
                many = np.diff(np.append(first, len(row)))
                row = row[first]
                source = row >> 33
                edges = np.append(_groups(source), len(row))
                yield _batch(
                    source=pa.array(source[edges[:-1]], pa.int64()),
                    payload=pa.array([
                        pack(steps(row[a:b]), total[a:b], smallest(many[a:b])) for a, b in zip(edges[:-1], edges[1:])
                    ], pa.binary()),
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, payloads in _by_block(batches):
            parts = [unpack(x) for x in payloads]
            row = np.concatenate([np.cumsum(x) for x, _, _ in parts])
            score = np.concatenate([x for _, x, _ in parts])
            many = np.concatenate([x.astype(np.int64) for _, _, x in parts])
            order = np.lexsort((score, row))
            first = _groups(row[order])
            yield _batch(
                row=row[order][first], score=np.add.reduceat(score[order], first),
                tokens=np.add.reduceat(many[order], first),
            )

    parts = []
    columns = ["payload", *_sums_names(order)]
    for lone, wave, folder in zip(alone, waves, folders):
        parts.append(stored(
            lone.select(*columns).unionByName(wave.select(*columns)).mapInArrow(run, "source long, payload binary"), "katz-parts"
        ))
        release(spark, folder)
    release(spark, *tables)
    dealt = reduce(DataFrame.unionByName, [part for part, _ in parts]).repartition("source").sortWithinPartitions("source")
    scored = written(dealt.mapInArrow(add, "row long, score double, tokens long"), "katz-scores")
    release(spark, *[folder for _, folder in parts])
    return scored


SUMS = ["total", *(f"small{r}" for r in range(1, KATZ_LIMIT + 1)), "mass"]
SUMS_TYPE = f"array<struct<key:long,{','.join(f'{x}:double' for x in SUMS)}>>"


def _sums_names(order: int) -> list[str]:
    return [f"sums{k}" for k in range(3, order + 1)]


def _block(batch: pa.RecordBatch, i: int, order: int) -> tuple[bytes, list]:
    """A block's payload, and for each longer order the keys and sums of its
    histories that lie in several blocks."""
    sums = []
    for name in _sums_names(order):
        rows = batch.column(name).slice(i, 1).flatten()
        keys = rows.field("key").to_numpy()
        sort = np.argsort(keys)
        sums.append((keys[sort], np.stack([rows.field(x).to_numpy() for x in SUMS])[:, sort]))
    return batch.column("payload")[i].as_py(), sums


def _with_sums(waves: list[DataFrame], shared, across, k: int) -> tuple[list[DataFrame], str]:
    """The waves of blocks, each block with the sums of its histories of k - 1
    words that lie in others too, and the folder that has the sums."""
    spark = waves[0].sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        by, split = across.value
        for batch in batches:
            for i in range(batch.num_rows):
                key, sums = _evaluated(model, by, split, *_block(batch, i, k - 1), sums_of=k)
                yield _batch(
                    block=pa.array(np.full(len(key), batch.column("block")[i].as_py(), np.int32)),
                    key=pa.array(key.view(np.int64)), **dict(zip(SUMS, sums)),
                )

    columns = ["block", "payload", *_sums_names(k - 1)]
    schema = "block int, key long, " + ", ".join(f"{x} double" for x in SUMS)
    stores = []
    for wave in waves:
        stores.append(stored(wave.select(*columns).mapInArrow(run, schema), "katz-sums"))
        release(spark)
    parts = reduce(DataFrame.unionByName, [part for part, _ in stores])
    # A key has a row in each block at most, so its window holds no more than that.
    key = Window.partitionBy("key")
    whole = parts.select(
        "block", "key", F.count("*").over(key).alias("parts"), *(F.sum(x).over(key).alias(x) for x in SUMS)
    ).where("parts > 1")
    sums, folder = stored(whole.groupBy("block").agg(
        F.collect_list(F.struct("key", *SUMS)).alias(f"sums{k}")
    ), "katz-histories")
    release(spark, *[stored_in for _, stored_in in stores])
    return [wave.select(*columns).join(sums, "block", "left") for wave in waves], folder


def _evaluated(model: Unigrams, bys: list, split: dict, payload: bytes, across=(), sums_of: int = 0):
    """Place and log10 probability of every token of a block; with ``sums_of``,
    keys and sums of the histories of that order that may lie in other blocks."""
    h, many, ranked, hashed, n, trained, size, least, at, *longer = unpack(payload)
    by = bys[0]
    h = np.cumsum(h, dtype=np.uint64)
    trained, size = trained.astype(np.int64), size.astype(np.int64)
    count = np.zeros(len(ranked), np.int64)
    count[ranked > 0] = model.counts[ranked[ranked > 0].astype(np.int64) - 1]
    count[ranked == 0] = n
    groups = np.cumsum(many, dtype=np.int64) - many
    total, *small, mass = _history_sums(model, h, count, trained, groups)
    total, small, mass = total.astype(float), np.array(small, float), mass.astype(float)
    if split:
        for i in np.flatnonzero(np.isin(h, np.array(list(split), np.uint64))):
            total[i], small[:, i], mass[i] = split[int(h[i])][0], split[int(h[i])][1:-1], split[int(h[i])][-1]
    used = total - ((1 - by[1:])[:, None] * small).sum(axis=0)
    below, free = left_over(total, used)
    weight = np.where(total > 0, free / np.maximum(1 - mass, 1e-300), 1.0)
    owner = np.repeat(np.arange(len(h)), many)
    with np.errstate(divide="ignore"):
        seen = np.log10(discounted(trained, by)) - np.log10(np.maximum(below, 1))[owner]
        backed = np.log10(weight)[owner] + np.log10(model.probability(count))
    value = np.where(trained > 0, seen, backed)
    if longer:
        grams, trained, size, *codes = longer
        trained, size, codes = trained.astype(np.int64), size.astype(np.int64), _decoded(codes)
        pair = np.repeat(np.arange(len(grams)), grams)
        value, last = value[pair], h[owner][pair]
        if sums_of:
            # A context belongs to its last word, and only these are in several blocks.
            hot = np.flatnonzero(np.isin(last, np.array(list(split), np.uint64)))
            pair, value, last, trained = pair[hot], value[hot], last[hot], trained[hot]
            codes = [x[hot] for x in codes]
        context = mix(last)
        for k in range(3, len(codes) + 3):
            context = mix(context ^ mix(codes[k - 3] + np.uint64(k)))
            first = _groups(pair, *codes[: k - 2])
            own, lower = np.add.reduceat(trained, first), value[first]
            key, at_key = np.unique(context[first], return_inverse=True)
            sums = np.array([
                np.bincount(at_key, own), *(np.bincount(at_key, np.where(own == r, r, 0)) for r in range(1, KATZ_LIMIT + 1)),
                np.bincount(at_key, np.where(own > 0, 10.0 ** lower, 0.0)),
            ], float)
            if sums_of == k:
                return key, sums
            known, found = across[k - 3]
            if len(known):
                place = np.minimum(np.searchsorted(known, key.view(np.int64)), len(known) - 1)
                same = known[place] == key.view(np.int64)
                sums[:, same] = found[:, place[same]]
            total, small, mass = sums[0], sums[1:-1], sums[-1]
            below, free = left_over(total, total - ((1 - bys[k - 2][1:])[:, None] * small).sum(axis=0))
            weight = np.where(total > 0, free / np.maximum(1 - mass, 1e-300), 1.0)
            with np.errstate(divide="ignore"):
                seen = np.log10(discounted(own, bys[k - 2])) - np.log10(np.maximum(below, 1))[at_key]
                backed = np.log10(weight)[at_key] + lower
            value = np.repeat(np.where(own > 0, seen, backed), np.diff(np.append(first, len(pair))))
    return at.astype(np.int64) + least[0], np.repeat(value, size)


def score(documents: DataFrame, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every document, by n-grams of up to ``order`` words (2 at least); documents with crc32(doc_id) % 10 = 0 are held out of
    training. Tokens are words (runs of bytes other than white space, A-Z in
    lower case) and one end per document, which is all that a null or empty
    text has. Repeated rows are scored one by one and count in training one by
    one; a null doc_id counts as an empty text, whose checksum 0 holds it out. Without training every token is unknown
    and has probability one."""
    if order < 2:
        raise ValueError("the order must be 2 at least")
    spark = documents.sparkSession
    blocks = BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, texts_folder = _rows(documents)
    counts, counts_folder = stored(count_words(texts, blocks), "katz-words")
    model = unigram_model(counts)
    shared = spark.sparkContext.broadcast(model)
    own, own_folder = stored(_own_figures(texts, shared), "katz-own", compression="zstd")
    # Each pass leaves shuffle files and tables that the next ones do not read.
    release(spark, texts_folder)
    rare, rare_folder = stored(_rare_pairs(own, counts, shared, order), "katz-rare")
    figures = written(_figures(own, rare, model), "katz-documents")
    release(spark, counts_folder)
    waves, folders = [], []
    for wave in range(WAVES):
        pairs = _pairs(own, rare, shared, blocks, order, wave, WAVES)
        part, folder = stored(build_blocks(pairs, shared, blocks), "katz-blocks")
        waves.append(part)
        folders.append(folder)
        release(spark)
    release(spark, own_folder, rare_folder)
    rows = figures.join(evaluate(waves, folders, shared, order), "row")
    # Every token has been evaluated once, or the scans have not agreed.
    whole = F.when(F.col("tokens") == F.col("n_tokens"), F.col("score")).otherwise(
        F.raise_error(F.lit("tokens were lost between two scans"))
    )
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", whole.alias("score"),
    )
