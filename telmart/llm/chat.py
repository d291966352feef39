"""Roles of transcripts by a hidden Markov model, and canonical turns.

A conversation is read as a sequence of lines. Hidden states are a role and
whether the line begins a turn or goes on with one. A line is observed by the
speaker marker that it starts with, its length, its last sign and its first
one. Turns usually come one to a row, but a row may hold a transcript of
several: within a row a turn goes on unless a marker speaks against it.

Viterbi runs over ranges of the sorted table. A conversation that lies in
several ranges is not brought together: its piece in each range yields one
matrix, the best log probability from each state before it to each state at its
end; the matrices, at most two a range, are chained, and each piece is decoded
between the states found for its ends.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telmart.llm.shared import written

# Roles, the markers of transcripts for each, and turn tokens.
ROLES = ("system", "user", "assistant")
MARKERS = (
    r"(?i)^\s*(?:#+\s*)?\[?(?:system|instructions?)\]?\s*[:>]\s*",
    r"(?i)^\s*(?:#+\s*)?\[?(?:user|human|question|q|customer|me)\]?\s*[:>]\s*",
    r"(?i)^\s*(?:#+\s*)?\[?(?:assistant|ai|bot|answer|a|agent|model)\]?\s*[:>]\s*",
)
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"

STATES = 2 * len(ROLES)  # role r begins in state r and goes on in r + len(ROLES)
# What is observed of a line, with the number of its values.
OBSERVED = {"marker": len(MARKERS) + 1, "length": 12, "sign": 4, "kind": 3, "row": 26}
# How likely a marker is at the beginning of a turn of its role, of a turn of
# another role, and within a turn; the weight of that beside the counts; and the
# chance that a row holds a further turn.
OWN_MARKER, OTHER_MARKER, INNER_MARKER = 0.48, 0.01, 1e-8
KNOWN_WEIGHT = 0.02
FURTHER_TURN = 1e-3


def observed(line: Column, number: Column, text: Column) -> list[Column]:
    """The observations of a line, in the order of OBSERVED; ``text`` is the
    row that it stands in, whose length its first line shows."""
    marker = F.lit(0)
    for i in reversed(range(len(MARKERS))):
        marker = F.when(line.rlike(MARKERS[i]), i + 1).otherwise(marker)
    bare = F.trim(line)
    last = F.substring(bare, -1, 1)
    length = F.least(F.log2(F.length(line) + 1).cast("int"), F.lit(OBSERVED["length"] - 1))
    sign = F.when(last == "?", 1).when(last == ":", 2).when(last.isin(".", "!"), 3).otherwise(0)
    kind = F.when(bare.rlike(r"^([-*•]|\d+[.)])\s"), 1).when(bare.rlike("^[`#|>]"), 2).otherwise(0)
    size = F.least((2 * F.log2(F.length(text) + 1)).cast("int") + 1, F.lit(OBSERVED["row"] - 1))
    return [marker, length, sign, kind, F.when(number == 0, size).otherwise(0)]


@dataclass
class Model:
    """Log probabilities: of a first state, from state to state at the start of
    a row and within one, and of each feature's values in each state."""

    first: np.ndarray
    between: np.ndarray
    within: np.ndarray
    emit: list[np.ndarray]

    def observe(self, values: list[np.ndarray]) -> np.ndarray:
        return sum(table[:, value] for table, value in zip(self.emit, values)).T


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def train(conversations: DataFrame) -> Model:
    """Counts over all rows with a known role, with one added to each. The
    turns of a conversation follow each other by number."""
    known = conversations.where(F.col("role").isin(*ROLES)).select("conv_id", "turn", "role", "text")
    lines = known.select("role", F.coalesce("text", F.lit("")).alias("text"), F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
    names = list(OBSERVED)
    seen = lines.select(
        "role", (F.col("line_no") > 0).cast("int").alias("inside"),
        *[value.alias(name) for name, value in zip(names, observed(F.col("line"), F.col("line_no"), F.col("text")))],
    )
    emit = []
    # A row for each state and combination of features: at most a few thousand.
    counts = seen.groupBy("role", "inside", *names).agg(F.count("*").alias("n")).collect()
    for name, size in OBSERVED.items():
        table = np.ones((STATES, size))
        if name == "marker":
            # What markers mean is known; how frequent they are is counted.
            table[:] = INNER_MARKER
            table[: len(ROLES)] = OTHER_MARKER
            table[np.arange(len(ROLES)), 1 + np.arange(len(ROLES))] = OWN_MARKER
            table[:, 0] = 1 - table[:, 1:].sum(axis=1)
        known_marks = table.copy()
        for row in counts:
            table[ROLES.index(row["role"]) + len(ROLES) * row["inside"], row[name]] += row["n"]
        table /= table.sum(axis=1, keepdims=True)
        if name == "marker":
            table = (1 - KNOWN_WEIGHT) * table + KNOWN_WEIGHT * known_marks
        if name == "row":
            # Lines further down show nothing of this, whatever they are.
            table[:, 0] = 1
        emit.append(np.log(table))
    turns = known.select("conv_id", "turn", "role")
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    steps = turns.join(earlier, ["conv_id", "turn"], "left").groupBy("before", "role").agg(F.count("*").alias("n")).collect()
    first, follow = np.ones(len(ROLES)), np.ones((len(ROLES), len(ROLES)))
    for row in steps:
        if row["before"] is None:
            first[ROLES.index(row["role"])] += row["n"]
        else:
            follow[ROLES.index(row["before"]), ROLES.index(row["role"])] += row["n"]
    first, follow = np.log(first / first.sum()), np.log(follow / follow.sum(axis=1, keepdims=True))
    never = np.full(len(ROLES), -np.inf)
    between = np.concatenate([np.tile(follow, (2, 1)), np.full((STATES, len(ROLES)), -np.inf)], axis=1)
    within = np.full((STATES, STATES), -np.inf)
    within[:, : len(ROLES)] = between[:, : len(ROLES)] + np.log(FURTHER_TURN)
    for state in range(STATES):
        within[state, len(ROLES) + state % len(ROLES)] = np.log1p(-FURTHER_TURN)
    return Model(np.concatenate([first, never]), between, within, emit)


def viterbi(
    model: Model, seen: np.ndarray, row_start: np.ndarray, bounds: np.ndarray, entry: np.ndarray, leave: list[int | None]
) -> tuple[np.ndarray, np.ndarray]:
    """The best states of many sequences at once, and the scores of their last
    states. ``entry`` has each sequence's scores of the state before it, or
    nan for one that begins; ``leave`` the state that it has to end in, if any."""
    size = np.diff(bounds)
    scores = np.zeros((len(size), STATES))
    back = np.zeros((len(seen), STATES), np.int8)
    order = np.argsort(-size, kind="stable")
    for step in range(int(size.max(initial=0))):
        active = order[: int(np.searchsorted(-size[order], -step, "left"))]
        at = bounds[active] + step
        if step == 0:
            start = entry[active]
            begins = np.isnan(start[:, 0])
            options = np.where(begins[:, None], 0, start)[:, :, None] + model.between
            best = options.argmax(axis=1)
            value = np.where(begins[:, None], model.first, options.max(axis=1))
        else:
            moves = np.where(row_start[at][:, None, None], model.between, model.within)
            options = scores[active][:, :, None] + moves
            best = options.argmax(axis=1)
            value = options.max(axis=1)
        back[at] = best
        scores[active] = value + seen[at]
    states = np.zeros(len(seen), np.int8)
    for sequence in np.flatnonzero(size):
        state = int(scores[sequence].argmax()) if leave[sequence] is None else leave[sequence]
        for at in range(bounds[sequence + 1] - 1, bounds[sequence] - 1, -1):
            states[at] = state
            state = int(back[at, state])
    return states, scores


def entries(model: Model, seen: np.ndarray, row_start: np.ndarray) -> np.ndarray:
    """Best scores from each state before a sequence, and from its being the
    beginning (last row), to each state at its end."""
    count = STATES + 1
    entry = np.full((count, STATES), -np.inf)
    entry[np.arange(STATES), np.arange(STATES)] = 0
    entry[STATES] = np.nan
    bounds = np.arange(count + 1) * len(seen)
    return viterbi(model, np.tile(seen, (count, 1)), np.tile(row_start, count), bounds, entry, [None] * count)[1]


def chain(pieces: list[np.ndarray]) -> list[int]:
    """The states at the ends of consecutive pieces on the best path."""
    scores, back = pieces[0][STATES], []
    for piece in pieces[1:]:
        options = scores[:, None] + piece[:STATES]
        back.append(options.argmax(axis=0))
        scores = options.max(axis=0)
    ends = [int(scores.argmax())]
    for best in reversed(back):
        ends.append(int(best[ends[-1]]))
    return ends[::-1]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of one range after the other, from rows sorted by range."""
    now, held = None, []
    for batch in batches:
        part = batch.column("part").to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        for a, b in zip(edges[:-1], edges[1:]):
            if a < b:
                if part[a] != now and held:
                    yield now, pa.Table.from_batches(held)
                    held = []
                now = int(part[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def _observed(model: Model, rows: pa.Table):
    """Scores of all lines of a range, where rows start, the lines before each
    row, and the rows before each conversation."""
    packed = rows.column("seen").combine_chunks()
    lines = np.concatenate([[0], np.cumsum(np.diff(packed.offsets.to_numpy()))])
    values, rest = [], packed.flatten().to_numpy()
    for size in reversed(OBSERVED.values()):
        values.insert(0, rest % size)
        rest = rest // size
    row_start = np.zeros(lines[-1], bool)
    row_start[lines[:-1]] = True
    new = rows.column("new").to_numpy()
    return model.observe(values), row_start, lines, np.append(np.flatnonzero(new), len(new))


ORDER = ["conv_id", "turn", "text", "role"]


def _sorted_rows(conversations: DataFrame) -> DataFrame:
    """All rows dealt out by ranges of conversation and turn, with the range,
    the place in it, whether a conversation begins or goes on there, and the
    observations of each line as one number."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("text", F.lit("")).alias("text"), "role"
    )
    ranged = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).drop("role")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, last = 0, object()
        for batch in batches:
            names = batch.column("conv_id").to_pylist()
            new = np.array([a != b for a, b in zip(names, [last, *names[:-1]])], bool)
            count, last, at = count + len(names), names[-1] if names else last, count
            yield batch.append_column("place", pa.array(at + np.arange(len(names)))).append_column("new", pa.array(new))

    def code(line: Column, number: Column) -> Column:
        out = F.lit(0)
        for size, value in zip(OBSERVED.values(), observed(line, number, F.col("text"))):
            out = out * size + value
        return out

    kind = rows.schema["conv_id"].dataType.simpleString()
    placed = ranged.mapInArrow(place, f"conv_id {kind}, turn long, text string, place long, new boolean")
    return placed.select(
        F.spark_partition_id().alias("part"), "place", "new", "conv_id", "turn", "text",
        F.transform(_lines(F.col("text")), code).alias("seen"),
    )


def _ends(rows: DataFrame, model: Model) -> dict[int, tuple]:
    """For each range with a conversation that lies in several ranges: the
    state before its first piece, and the states that its first and its last
    piece end in, where they are settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in _parts(batches):
            seen, row_start, lines, conversations = _observed(model, table)
            names = table.column("name").to_pylist()
            pieces = []
            for piece in (0, len(conversations) - 2):
                at = slice(lines[conversations[piece]], lines[conversations[piece + 1]])
                pieces.append(entries(model, seen[at], row_start[at]).tobytes())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "one": pa.array([len(conversations) == 2]),
                "first": pa.array([names[0]], pa.string()), "last": pa.array([names[-1]], pa.string()),
                "head": pa.array([pieces[0]], pa.binary()), "tail": pa.array([pieces[1]], pa.binary()),
            })

    # One row per range.
    found = sorted(
        _dealt(rows.select("part", "place", "new", "seen", F.col("conv_id").cast("string").alias("name")))
        .mapInArrow(run, "part int, one boolean, first string, last string, head binary, tail binary").collect()
    )
    read = lambda data: np.frombuffer(bytes(data)).reshape(STATES + 1, STATES)
    chains: list[list[tuple[int, bool, np.ndarray]]] = []
    for i, row in enumerate(found):
        if i and found[i - 1]["last"] == row["first"]:
            chains[-1].append((row["part"], True, read(row["head"])))
        else:
            chains.append([(row["part"], True, read(row["head"]))])
        if not row["one"]:
            chains.append([(row["part"], False, read(row["tail"]))])
    settled: dict[int, list] = {}
    for pieces in chains:
        if len(pieces) > 1:
            ends = chain([matrix for _, _, matrix in pieces])
            for i, (part, is_head, _) in enumerate(pieces):
                own = settled.setdefault(part, [None, None, None])
                if is_head:
                    own[0], own[1] = (ends[i - 1] if i else None), ends[i]
                else:
                    own[2] = ends[i]
    return {part: tuple(own) for part, own in settled.items()}


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part", "place")


_STRIP = [re.compile(marker) for marker in MARKERS]


def rendered(role: str, text: str) -> str:
    """A canonical turn; turn tokens within the text are broken up."""
    for token in (TURN_START, TURN_END):
        text = text.replace(token, token.replace("<|", "< |"))
    return f"{TURN_START}{role}\n{text}{TURN_END}\n"


def canonical_turns(conversations: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, segment, role, text, rendered: the turns of every
    conversation in canonical form, with roles recovered from the lines alone.

    ``conversations`` has conv_id, turn and text; a role is not looked at but
    for the order of rows that are alike otherwise. Rows of a conversation are
    taken by turn, null first, then by text. A row is one turn, segment 0, or
    several, if markers within it begin further ones. A marker of the recovered
    role is taken off. A null text is one empty line, rows with a null conv_id
    are one conversation, repeated rows are turns of their own.
    """
    rows = written(_sorted_rows(conversations), "chat-rows")
    settled = _ends(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in _parts(batches):
            seen, row_start, lines, conversations = _observed(model, table)
            before, head, tail = settled.get(part, (None, None, None))
            count = len(conversations) - 1
            entry = np.full((count, STATES), np.nan)
            if before is not None:
                entry[0] = -np.inf
                entry[0, before] = 0
            leave: list[int | None] = [None] * count
            if tail is not None:
                leave[-1] = tail
            if head is not None:
                leave[0] = head
            states, _ = viterbi(model, seen, row_start, lines[conversations], entry, leave)
            out: dict[str, list] = {"row": [], "turn": [], "segment": [], "role": [], "text": [], "rendered": []}
            turns = table.column("turn").to_pylist()
            for i, text in enumerate(table.column("text").to_pylist()):
                own, parts = states[lines[i]: lines[i + 1]], text.split("\n")
                starts = [0, *[k for k in range(1, len(own)) if own[k] < len(ROLES)], len(own)]
                for segment, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
                    role = int(own[a]) % len(ROLES)
                    body = "\n".join([_STRIP[role].sub("", parts[a], count=1), *parts[a + 1: b]])
                    for name, value in zip(out, (i, turns[i], segment, ROLES[role], body, rendered(ROLES[role], body))):
                        out[name].append(value)
            names = table.column("conv_id").combine_chunks().take(pa.array(out.pop("row"), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(out["turn"], pa.int64()), pa.array(out["segment"], pa.int32()),
                 *[pa.array(out[x], pa.string()) for x in ("role", "text", "rendered")]],
                ["conv_id", *out],
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    return _dealt(rows.select("part", "place", "new", "seen", "conv_id", "turn", "text")).mapInArrow(
        run, f"conv_id {kind}, turn long, segment int, role string, text string, rendered string"
    )
