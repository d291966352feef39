"""Identifiers against the libraries, and files that are read back."""

import io
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from telmart.llm import frames, pieces, tokenfiles
from telmart.llm.packing import pack, unpack
from telmart.llm.shared import flat, open_folder, vocabulary
from telmart.session import new_folder

BYTES, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TEXT = st.one_of(
    st.text(max_size=80), st.text("ab \n", max_size=60), st.text("th e\té▁=0 　\u0085", max_size=60),
)


@pytest.fixture(scope="module")
def piece_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    return library


def split(values, counts):
    ends = list(accumulate(counts.tolist(), initial=0))
    return [values[a:b] for a, b in zip(ends, ends[1:])]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_pieces_as_the_library(piece_library, texts):
    coder = pieces.pieces(PIECES)
    ids, counts = coder.encode(*flat(pa.array(texts, pa.string())))
    wanted = [piece_library.encode(text, add_bos=True, add_eos=True) for text in texts]
    assert [x.tolist() for x in split(ids, counts)] == wanted
    data, sizes = coder.decode(ids, counts)
    assert [x.tobytes().decode() for x in split(data, sizes)] == [piece_library.decode(x) for x in wanted]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_bytes_as_the_library(byte_library, texts):
    ids, counts = tokenfiles.encoder(BYTES).encode(*flat(pa.array(texts, pa.string())))
    wanted = [byte_library.encode(text, add_special_tokens=False).ids for text in texts]
    assert [x.tolist() for x in split(ids, counts)] == wanted


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "x", "word", "é", "\u3000", "\u00a0", ".", "<", "|>"]
), max_size=14).map("".join), max_size=8))
def test_added_tokens_as_the_unchanged_library(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    texts = ["x <|endoftext|> y", *texts, "<|endof", "text|> b <|endoftext|><|endoftext|>\n"]
    ids, counts = tokenfiles.encoder(BYTES).encode(*flat(pa.array(texts, pa.string())))
    wanted = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert [x.tolist() for x in split(ids, counts)] == wanted
    assert 50256 in wanted[0]


@pytest.mark.parametrize("options", [{"lstrip": True}, {"rstrip": True}, {"single_word": True}, {}])
def test_other_added_tokens(tmp_path, options):
    from tokenizers import AddedToken, Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.add_tokens([AddedToken(" ab c", normalized=False), AddedToken("\u00b5m", normalized=False, **options)])
    library.add_special_tokens([AddedToken("<mask>", normalized=False, **options)])
    path = str(tmp_path / "added.json")
    library.save(path)
    texts = ["a <mask> b", "a<mask>b", "one <mask>\n two", "x ab c ab", "y ab", "c z ab c", "3 \u00b5m 4 \u00b5m", "<mask> <mask>"]
    ids, counts = tokenfiles.Encoder(path).encode(*flat(pa.array(texts, pa.string())))
    assert [x.tolist() for x in split(ids, counts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_pieces_of_a_table(spark, documents, odd_texts, piece_library):
    long = ["a" * 20_000, "=" * 7_000 + "-" * 7_000, "ab" * 5_000, "漢字" * 4_000, " " * 3_000]
    rows = list(enumerate(odd_texts + long)) + [(None, "x"), (1, "again")]
    found = pieces.encode_texts(documents(rows), PIECES).collect()
    got = sorted((row.doc_id is None, row.doc_id, np.frombuffer(row.ids, "<u4").tolist(), row.decoded) for row in found)
    wanted = []
    for doc_id, text in rows:
        ids = piece_library.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((doc_id is None, doc_id, ids, piece_library.decode(ids)))
    assert got == sorted(wanted)
    assert all(row.n_tokens * 4 == len(row.ids) for row in found)
    assert pieces.encode_texts(documents([]), PIECES).collect() == []


def test_files_are_read_back(spark, documents, odd_texts, byte_library):
    rows = [(50 - i, text) for i, text in enumerate(odd_texts)] + [(None, "b"), (None, "a"), (7, "again")]
    folder = new_folder(spark, "tokens-test")
    manifest = tokenfiles.write_tokens(documents(rows), folder, BYTES)
    found = sorted(tokenfiles.read_tokens(spark, manifest, folder).collect(), key=lambda row: row.start)
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    wanted = [[*byte_library.encode(text or "", add_special_tokens=False).ids, 2] for _, text in ordered]
    assert [row.doc_id for row in found] == [doc_id for doc_id, _ in ordered]
    assert [np.frombuffer(row.ids, "<u4").tolist() for row in found] == wanted
    assert [row.start for row in found] == list(accumulate(map(len, wanted), initial=0))[:-1]
    few = tokenfiles.read_tokens(spark, manifest, folder, [50, 31]).collect()
    assert sorted(row.doc_id for row in few) == [31, 50]
    files, root = open_folder(folder)
    names = [row.file for row in manifest.collect()]
    assert sorted(x.base_name for x in files.get_file_info(__import__("pyarrow").fs.FileSelector(root))) == sorted(names)


def test_empty_table_has_empty_files(spark, documents):
    folder = new_folder(spark, "tokens-none")
    manifest = tokenfiles.write_tokens(documents([]), folder, BYTES)
    assert tokenfiles.read_tokens(spark, manifest, folder).collect() == []


def test_long_documents_span_frames(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FRAME_TOKENS", 10)
    monkeypatch.setattr(tokenfiles, "LONGEST_FRAME", 16)
    files, root = open_folder(str(tmp_path))
    docs = [np.arange(n, dtype="<u4") for n in (3, 4, 9, 55, 1, 0 + 1, 30)]
    tokenfiles._write_file(files, f"{root}/x", iter([
        ([0, 1, None], np.concatenate(docs[:3]), np.array([3, 4, 9])), ([3, 4, 5, 6], np.concatenate(docs[3:]), np.array([55, 1, 1, 30])),
    ]))
    read = []
    with frames.opened(files, f"{root}/x") as reader:
        plain = reader.frame
        reader.frame = lambda number: (read.append(number), plain(number))[1]
        assert [x.tolist() for _, _, x in tokenfiles.documents_in(reader)] == [x.tolist() for x in docs]
        read.clear()
        assert [name for name, _, _ in tokenfiles.documents_in(reader, {1})] == [1]
        assert len(read) == 2, "the index and one frame"


def test_frames_are_checked():
    stream = io.BytesIO()
    writer = frames.FrameWriter(stream)
    parts = [b"first" * 100, b"", b"second" * 1000]
    for part in parts:
        writer.add(part)
    writer.finish()
    data = stream.getvalue()
    reader = frames.FrameReader(io.BytesIO(data), len(data))
    assert [reader.frame(i) for i in (2, 0, 1)] == [parts[2], parts[0], parts[1]]
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    assert whole.read() == b"".join(parts), "a plain reader skips the table"
    broken = bytearray(data)
    broken[-9 - 12 * 3 + 8] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        frames.FrameReader(io.BytesIO(bytes(broken)), len(broken)).frame(0)
    with pytest.raises(ValueError, match="seek table"):
        frames.FrameReader(io.BytesIO(data[:-1]), len(data) - 1)


def test_packed_arrays():
    arrays = [np.arange(5), np.zeros(0, np.uint8), np.array([1.5, -2.0]), np.array([2 ** 63], np.uint64)]
    assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(arrays, unpack(pack(*arrays))))
