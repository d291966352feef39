"""Text quality by a factorisation machine.

Features of a text: its different words, hashed; structure statistics (shares
of capitals, digits, signs and so on) in steps; its stated length as metadata.
The score is a weight for each feature plus an inner product of two short
factor vectors for each pair of features. The pairs are summed in linear time:
sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telmart.llm.shared import binary, flat, slices, text_of
from telmart.llm.shingles import mix, words

# Rows that a model is fitted on at most: those with the smallest hash of their
# identifier. Everything else covers all rows.
SAMPLE_ROWS = 8192
WORD_BITS = 18
FACTORS = 8
UPDATES = 800
BATCH_ROWS = 128
RATE = 0.1
DECAY = 1e-5
STEPS = 64
# The value of a structure feature; the words of a text have a norm of 1.
STATISTIC = 0.5

_CAPITAL, _DIGIT, _SIGN, _WIDE = (np.zeros(256, bool) for _ in range(4))
_CAPITAL[65:91] = True
_DIGIT[48:58] = True
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_WIDE[128:] = True
_MILD = np.zeros(256, bool)
_MILD[list(b".,;:?'")] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share in steps that are finest near zero."""
    return (np.sqrt(part / np.maximum(whole, 1)) * 24).astype(np.int64)


def _log(count: np.ndarray) -> np.ndarray:
    return (2 * np.log2(1 + np.asarray(count, np.float64))).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, their values, and the features before each text.
    ``stated`` is the length in the metadata, negative where there is none."""
    texts = len(offsets) - 1
    start, end, hashes, bounds = words(data, offsets)
    text = np.repeat(np.arange(texts), np.diff(bounds))
    key = np.sort((text << WORD_BITS) | (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    owner = key >> WORD_BITS
    different = np.bincount(owner, minlength=texts)
    size, count = np.diff(offsets), np.diff(bounds)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    strange = (_SIGN & ~_MILD)
    statistics = [
        _share(_per_text(_CAPITAL[data], offsets), size),
        _share(_per_text(_DIGIT[data], offsets), size),
        _share(_per_text(strange[data], offsets), size),
        _share(_per_text(_WIDE[data], offsets), size),
        _share(_per_text(data == 10, offsets), count),
        _share(_per_text(_MILD[last], bounds), count),
        _share(_per_text(strange[last], bounds), count),
        _share(_per_text(end - start <= 3, bounds), count),
        _share(_per_text((end - start == 1) & strange[last], bounds), count),
        _share(different, count),
        _log(size / np.maximum(count, 1) * 4),
        _log(count),
        _log(np.maximum(stated, 0)) + (stated >= 0),
    ]
    numbers = (1 << WORD_BITS) + np.stack([
        np.minimum(column, STEPS - 1) + STEPS * i for i, column in enumerate(statistics)
    ], axis=1)
    each = different + len(statistics)
    before = np.concatenate([[0], np.cumsum(each)])
    at = np.arange(len(key)) + np.repeat(before[:-1] - (np.cumsum(different) - different), different)
    out = np.zeros(before[-1], np.int32)
    value = np.full(before[-1], STATISTIC, np.float32)
    mask = np.zeros(before[-1], bool)
    mask[at] = True
    out[mask] = key & ((1 << WORD_BITS) - 1)
    value[mask] = 1 / np.sqrt(different[owner])
    out[~mask] = numbers.ravel()
    return out, value, before


WIDTH = (1 << WORD_BITS) + 13 * STEPS


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, number: np.ndarray, value: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The score before the logistic step, in linear time. Every text has
        features, so no run is empty."""
        starts = before[:-1]
        if not len(starts):
            return np.zeros(0)
        linear = np.add.reduceat(self.weights[number] * value, starts)
        scaled = self.factors[number] * value[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(np.einsum("ij,ij->i", scaled, scaled), starts)
        return self.bias + linear + 0.5 * (np.einsum("ij,ij->i", sums, sums) - squares)


def fit(number: np.ndarray, value: np.ndarray, before: np.ndarray, label: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad. Features that no sample has weigh nothing.
    Without samples, or with one label only, the score is constant."""
    rate = (label.sum() + 1) / (len(label) + 2)
    model = Machine(float(np.log(rate / (1 - rate))), np.zeros(WIDTH, np.float32), np.zeros((WIDTH, FACTORS), np.float32))
    if len(label) == 0 or label.min() == label.max():
        return model
    random = np.random.default_rng(seed)
    seen = np.unique(number)
    model.factors[seen] = random.normal(0, 0.05, (len(seen), FACTORS))
    weight_sum = np.full(WIDTH, 1e-3, np.float32)
    factor_sum = np.full((WIDTH, FACTORS), 1e-3, np.float32)
    bias_sum = 1e-3
    size = np.diff(before)
    done = 0
    while done < UPDATES:
        order = random.permutation(len(label))
        for first in range(0, len(order), BATCH_ROWS):
            done += 1
            rows = order[first: first + BATCH_ROWS]
            many = size[rows]
            stop = np.cumsum(many)
            at = np.repeat(before[rows] - (stop - many), many) + np.arange(stop[-1])
            x, v = number[at], value[at]
            edges = np.concatenate([[0], stop])
            error = (1 / (1 + np.exp(-model.raw(x, v, edges))) - label[rows]) / len(rows)
            each = np.repeat(error, many)
            scaled = model.factors[x] * v[:, None]
            sums = np.repeat(np.add.reduceat(scaled, edges[:-1], axis=0), many, axis=0)
            used, which = np.unique(x, return_inverse=True)
            weight_step = np.bincount(which, each * v, len(used)) + DECAY * model.weights[used]
            pull = (each * v)[:, None] * (sums - scaled)
            factor_step = np.stack([np.bincount(which, pull[:, k], len(used)) for k in range(FACTORS)], axis=1)
            factor_step += DECAY * model.factors[used]
            weight_sum[used] += weight_step ** 2
            factor_sum[used] += factor_step ** 2
            bias_sum += error.sum() ** 2
            model.weights[used] -= RATE * weight_step / np.sqrt(weight_sum[used])
            model.factors[used] -= RATE * factor_step / np.sqrt(factor_sum[used])
            model.bias -= RATE * error.sum() / np.sqrt(bias_sum)
    return model


def _inputs(documents: DataFrame) -> DataFrame:
    """doc_id, text and stated length; the length is taken from the metadata
    where there is some."""
    stated = F.col("n_chars").cast("double") if "n_chars" in documents.columns else F.lit(None).cast("double")
    return documents.select("doc_id", text_of().alias("text"), F.coalesce(stated, F.lit(-1.0)).alias("stated"))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fits a machine on at most ``sample_rows`` labelled rows. ``labels`` has
    doc_id and quality, 1 or 0; other values and null identifiers are passed
    over. The sample and its features, some 2 KB a row, come to the driver."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    )
    # The limit bounds this side.
    rows = _inputs(documents).join(F.broadcast(chosen), "doc_id").select("quality", "text", "stated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                number, value, before = features(*flat(part.column("text")), part.column("stated").to_numpy())
                many = np.diff(before)
                yield pa.RecordBatch.from_arrays(
                    [part.column("quality"), binary(number, many), binary(value, many)], ["quality", "number", "value"]
                )

    found = rows.mapInArrow(run, "quality int, number binary, value binary").toArrow().combine_chunks()
    if not found.num_rows:
        return fit(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64), np.zeros(0))
    number = [np.frombuffer(x, np.int32) for x in found.column("number").to_pylist()]
    value = [np.frombuffer(x, np.float32) for x in found.column("value").to_pylist()]
    # The rows arrive in no fixed order; the content puts them into one.
    label = found.column("quality").to_numpy().astype(np.float64)
    order = sorted(range(len(number)), key=lambda i: (len(number[i]), int(mix(number[i].astype(np.uint64)).sum()), label[i]))
    before = np.concatenate([[0], np.cumsum([len(number[i]) for i in order])])
    return fit(np.concatenate([number[i] for i in order]), np.concatenate([value[i] for i in order]), before, label[order])


def _scores(model: Machine, text: pa.Array, stated: np.ndarray) -> np.ndarray:
    raw = model.raw(*features(*flat(text), stated))
    return 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -500, 500)))


def only_good(documents: DataFrame, model: Machine, least: float = 0.5) -> DataFrame:
    """The documents with a score of at least ``least``, with all their
    columns; nothing is moved."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    has_length = "n_chars" in documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                stated = np.full(part.num_rows, -1.0)
                if has_length:
                    stated = part.column("n_chars").cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False)
                yield part.filter(pa.array(_scores(shared.value, part.column("text"), stated) >= least))

    return documents.mapInArrow(run, documents.schema)


def score(documents: DataFrame, model: Machine) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of every document.

    Whole texts count. A null text is an empty one, which is scored by its
    structure; a null length has a step of its own. Rows stay as they are,
    repeated or null identifiers too. The model has a fixed size.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                value = _scores(shared.value, part.column("text"), part.column("stated").to_numpy())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    rows = _inputs(documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
