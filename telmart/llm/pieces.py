"""SentencePiece BPE with byte fallback, encoded and decoded in numpy.

The model file supplies the pieces and their scores; the merging is done here
for all different words of a batch at once. Every piece holds blanks at its
start only, so no merge crosses from another character to a blank: the text
falls into words (blanks and what follows them) that are encoded apart. Nor
does a merge cross two characters that stand side by side in no piece, which
keeps long runs without blanks short.

Each round finds the best pair rank of every word and merges it at its
leftmost places; then the arrays are compacted and finished words leave. All
places of that pair merge at once where the pairs that arise on the way rank
lower than it; else only the leftmost does, as the library would.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telmart.llm.shared import binary, flat, slices, text_of
from telmart.llm.shingles import span_hashes

# Fixed values of the model format.
BLANK = "▁"
UNKNOWN_SURFACE = " ⁇ "
NO_RANK = np.int64(1) << 40
# Text that a task encodes at a time: more finds more equal words and holds more.
BYTES_AT_ONCE = 3 << 20


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.vocab_size()
        self.begin, self.end, self.unknown = library.bos_id(), library.eos_id(), library.unk_id()
        names = [library.id_to_piece(i) for i in range(size)]
        fallback = {i: int(names[i][3:5], 16) for i in range(size) if library.is_byte(i)}
        hidden = {i for i in range(size) if library.is_control(i)}
        ordinary = {
            name: i for i, name in enumerate(names)
            if i not in fallback and i not in hidden and i != self.unknown
        }
        if len(fallback) != 256 or any(BLANK in name.lstrip(BLANK) for name in ordinary):
            raise ValueError("the model needs byte fallback and blanks at the start of pieces only")
        if library.decode(library.encode("  a  b ")) != "  a  b ":
            raise ValueError("the model must leave blanks as they are")
        self._size = size
        self._of_byte = np.zeros(256, np.int32)
        for i, value in fallback.items():
            self._of_byte[value] = i
        scores = np.array([library.get_score(i) for i in range(size)])
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self._char = np.full(0x110000, -1, np.int32)
        beside, keys, ids = set(), [], []
        for name, i in ordinary.items():
            if len(name) == 1:
                self._char[ord(name)] = i
            beside.update(zip(name, name[1:]))
            for cut in range(1, len(name)):
                left, right = ordinary.get(name[:cut]), ordinary.get(name[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    ids.append(i)
        order = np.argsort(keys)
        self._keys = np.array(keys, np.int64)[order]
        self._merged = np.array(ids, np.int32)[order]
        self._ranks = ranks[self._merged]
        self._beside = np.sort(np.array([(ord(a) << 21) | ord(b) for a, b in beside], np.int64))
        surface = [
            b"" if i in hidden else bytes([fallback[i]]) if i in fallback
            else UNKNOWN_SURFACE.encode() if i == self.unknown else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)
        ]
        self._surface = np.frombuffer(b"".join(surface), np.uint8)
        self._surface_size = np.array([len(x) for x in surface], np.int64)
        self._surface_at = np.cumsum(self._surface_size) - self._surface_size
        self._blank_first = np.zeros(size, bool)
        self._blank_first[[i for name, i in ordinary.items() if name.startswith(BLANK)]] = True

    # Merging

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; NO_RANK where they form no piece."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self._size + right)
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        hit = self._keys[at] == key
        return np.where(hit, self._ranks[at], NO_RANK), np.where(hit, self._merged[at], -1)

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merges each word's symbols (pieces, or -1) to the end. Returns what
        is left: pieces, the symbol each begins at, and the bounds by word."""
        origin = np.arange(len(symbols))
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        inner = np.append(word[1:] == word[:-1], False)[: len(symbols)]
        rank = np.full(len(symbols), NO_RANK)
        piece = np.full(len(symbols), -1, np.int32)
        at = np.flatnonzero(inner)
        rank[at], piece[at] = self._pairs(symbols[at], symbols[at + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            finished = best == NO_RANK
            if finished.any():
                out = np.repeat(finished, sizes)
                done.append((word[out], symbols[out], origin[out]))
                word, symbols, origin, rank, piece = (x[~out] for x in (word, symbols, origin, rank, piece))
                starts = starts[~finished] - (np.cumsum(sizes * finished) - sizes * finished)[~finished]
                sizes, best = sizes[~finished], best[~finished]
                if not len(symbols):
                    break
            place = np.flatnonzero(rank == np.repeat(best, sizes))
            # Of overlapping places every second one, from the left.
            apart = np.append(True, (np.diff(place) > 1))
            run = np.flatnonzero(apart)
            turn = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
            place = place[turn % 2 == 0]
            merged = symbols.copy()
            merged[place] = piece[place]
            first = np.append(True, word[place][1:] != word[place][:-1])
            # What a merge meets when it happens: on its left the merged
            # symbol before it, on its right the old one.
            left = place - 1
            gone = np.zeros(len(symbols) + 1, bool)
            gone[place + 1] = True
            left = np.where(gone[left] & (left >= 0), left - 1, left)
            has_left = (left >= 0) & (word[left] == word[place])
            right = np.minimum(place + 2, len(symbols) - 1)
            has_right = (place + 2 < len(symbols)) & (word[right] == word[place])
            many = np.bincount(word[place] - word[0], minlength=1)[word[place] - word[0]] > 1
            check = np.flatnonzero(many)
            if len(check):
                limit = rank[place[check]]
                low = (has_left[check] & (self._pairs(merged[left[check]], merged[place[check]])[0] <= limit)) | (
                    has_right[check] & (self._pairs(merged[place[check]], symbols[right[check]])[0] <= limit)
                )
                if low.any():
                    unsafe = np.isin(word[place], word[place[check[low]]])
                    place = place[~unsafe | first]
                    merged = symbols.copy()
                    merged[place] = piece[place]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            touched = np.zeros(len(symbols), bool)
            touched[place] = True
            before = place - 1
            before = np.where((before >= 0) & ~keep[before], before - 1, before)
            touched[before[(before >= 0) & (word[before] == word[place])]] = True
            symbols, word, origin, rank, piece, touched = (
                x[keep] for x in (merged, word, origin, rank, piece, touched)
            )
            at = np.flatnonzero(touched)
            joined = np.zeros(len(at), bool)
            within = at + 1 < len(symbols)
            joined[within] = word[at[within]] == word[at[within] + 1]
            rank[at], piece[at] = NO_RANK, -1
            at = at[joined]
            rank[at], piece[at] = self._pairs(symbols[at], symbols[at + 1])
        if not done:
            return symbols, origin, np.zeros(len(bounds), np.int64)
        word, symbols, origin = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], origin[order], np.searchsorted(word[order], np.arange(len(bounds)))

    def _words(self, data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of the given words (their bytes end to end), and how
        many for each."""
        text = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        raw = np.frombuffer(data, np.uint8)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)
        bounds = np.searchsorted(begins, np.concatenate([[0], np.cumsum(sizes)]))
        codes = np.where(text == 32, ord(BLANK), text)
        pair = (codes[:-1] << 21) | codes[1:]
        near = np.minimum(np.searchsorted(self._beside, pair), len(self._beside) - 1)
        cut = np.flatnonzero(self._beside[near] != pair) + 1
        edge = np.zeros(len(codes) + 1, bool)
        edge[bounds] = True
        edge[cut] = True
        split = np.flatnonzero(edge)
        symbols, origin, _ = self.merge(self._char[codes], split)
        # Characters without a piece become their bytes.
        width = np.diff(np.append(begins, len(raw)))
        wide = np.array([3], np.int64)
        lost = symbols < 0
        many = np.where(lost, np.where(codes[origin] == ord(BLANK), wide, width[origin]), 1)
        ids = np.repeat(symbols, many)
        at = np.flatnonzero(np.repeat(lost, many))
        if len(at):
            step = np.arange(len(ids)) - np.repeat(np.cumsum(many) - many, many)
            ids[at] = self._of_byte[raw[np.repeat(begins[origin], many)[at] + step[at]]]
        owner = np.searchsorted(bounds, origin, "right") - 1
        return ids, np.bincount(owner, many, len(sizes)).astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers with begin and end of all texts, and how many each."""
        texts = len(offsets) - 1
        filled = np.flatnonzero(np.diff(offsets))
        # A blank goes before each text that is not empty.
        text = np.insert(data, offsets[filled], 32)
        shift = np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        bounds = offsets + shift
        counts = np.zeros(texts, np.int64)
        inner = np.zeros(0, np.int64)
        if len(text):
            blank = text == 32
            start = blank & np.append(True, ~blank[:-1])
            start[3:] &= ~((text[:-3] == 0xE2) & (text[1:-2] == 0x96) & (text[2:-1] == 0x81))
            start[bounds[filled]] = True
            start = np.flatnonzero(start)
            end = np.append(start[1:], len(text))
            hashes = span_hashes(text, start, end)
            order = np.argsort(hashes)
            new = np.append(True, hashes[order][1:] != hashes[order][:-1])
            at = order[new]
            which = np.empty(len(order), np.int64)
            which[order] = np.cumsum(new) - 1
            sizes = (end - start)[at]
            place = np.repeat(start[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            pool, size = self._words(text[place].tobytes(), sizes)
            many = size[which]
            stop = np.cumsum(many)
            begin = (np.cumsum(size) - size)[which]
            inner = pool[np.repeat(begin - (stop - many), many) + np.arange(stop[-1])]
            owner = np.searchsorted(bounds, start, "right") - 1
            rows, first = np.unique(owner, return_index=True)
            counts[rows] = np.add.reduceat(many, first)
        ends = np.cumsum(counts)
        ids = np.insert(inner, np.concatenate([ends - counts, ends]), [self.begin] * texts + [self.end] * texts)
        # Of two insertions at one place, an end comes before a begin.
        total = counts + 2
        stop = np.cumsum(total)
        ids[stop - total], ids[stop - 1] = self.begin, self.end
        return ids.astype("<u4"), total

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts, and how many each. Without the blank that
        stands before a text; control pieces have no surface."""
        ids = ids.astype(np.int64)
        size = self._surface_size[ids].copy()
        begin = self._surface_at[ids].copy()
        text = np.repeat(np.arange(len(counts)), counts)
        shown = np.flatnonzero(size > 0)
        first = shown[np.append(True, text[shown][1:] != text[shown][:-1])] if len(shown) else shown
        first = first[self._blank_first[ids[first]]]
        size[first] -= 1
        begin[first] += 1
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        data = self._surface[np.repeat(begin - (stop - size), size) + np.arange(total)]
        return data, np.bincount(text, size, len(counts)).astype(np.int64)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_texts(documents: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers, begin and
    end included), decoded (the text that the identifiers stand for).

    A null text counts as empty: begin and end, and an empty decoded text. Rows
    stay as they are, repeated or null identifiers too; other columns are
    ignored. ``model`` is a model file on every machine.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            for part in slices(batch, "text", BYTES_AT_ONCE):
                ids, counts = coder.encode(*flat(part.column("text")))
                data, sizes = coder.decode(ids, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(counts, pa.int64()), binary(ids, counts),
                        pa.array([x.decode("utf-8", "replace") for x in binary(data, sizes).to_pylist()], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    rows = documents.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, decoded string")
