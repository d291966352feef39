"""Alignment against a plain program on the two libraries' own tokens."""

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from telmart.llm import alignment
from telmart.llm.shared import flat, vocabulary

BYTES, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def byte_of_char():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {chr(x): x for x in plain}, 256
    for x in range(256):
        if x not in plain:
            table[chr(extra)] = x
            extra += 1
    return table


CHARS = byte_of_char()


def plain_document(libraries, text):
    """Both sides' (identifier, begin, end), or nothing."""
    a_library, b_library = libraries
    if not text:
        return [], []
    spaced = b" " + text.encode()
    a = [(i, bytes(CHARS[c] for c in a_library.id_to_token(i))) for i in a_library.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in b_library.encode(text):
        piece = b_library.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(x for _, x in a) != spaced or b"".join(x for _, x in b) != spaced:
        return [], []

    def placed(tokens):
        out, at = [], 0
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    return placed(a), placed(b)


def plain_rows(libraries, rows):
    documents = [(doc_id, *plain_document(libraries, text)) for doc_id, text in rows]
    links = []
    for _, a, b in documents:
        found, j = [], 0
        for i, begin, end in a:
            while j and b[j][1] > begin:
                j -= 1
            while j < len(b) and b[j][2] <= begin:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                found.append((i, b[k][0]))
                k += 1
        links.append(found)
    count = Counter(pair for found in links for pair in set(found))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (doc_id, a, b), found in zip(documents, links):
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        for end in shared:
            left = ",".join(str(i) for i, s, e in a if begin <= s and e <= end)
            right = ",".join(str(i) for i, s, e in b if begin <= s and e <= end)
            groups.append(f"{left}|{right}")
            begin = end
        out.append((
            doc_id, len(a), len(b), len(groups), len(found), sum(count[x] == best[x[0]] for x in found),
            sum(count[x] for x in found), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        ))
    return out


def spark_result(frame):
    return [tuple(row) for row in frame.collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def test_documents(spark, libraries):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    short = [(i, text) for i, text in rows if len(text or "") < 6000]
    frame = spark.createDataFrame(short, "doc_id long, text string").repartition(3)
    assert ordered(spark_result(alignment.aligned_tokens(frame, BYTES, PIECES))) == ordered(plain_rows(libraries, short))


def test_rare_pairs_by_the_join(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_SHARE", 0.01)
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 5)
    rows = [(i, f"the same words {'again ' * (i % 4)} and number {i * 7919} Ünder") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ordered(spark_result(alignment.aligned_tokens(frame, BYTES, PIECES))) == ordered(plain_rows(libraries, rows))


def test_odd_rows(spark, libraries, documents, odd_texts):
    rows = [(i, text) for i, text in enumerate(odd_texts) if len(text or "") < 20_000]
    rows += [(None, "no identifier"), (1, "repeated"), (1, "repeated"), (70, "x<|endoftext|>y <s> z"), (71, "a▁b"), (72, "\x00\x01  ")]
    result = alignment.aligned_tokens(documents(rows), BYTES, PIECES)
    assert ordered(spark_result(result)) == ordered(plain_rows(libraries, rows))


def test_empty_table(spark, documents):
    result = alignment.aligned_tokens(documents([]), BYTES, PIECES)
    assert result.count() == 0 and result.columns[-1] == "groups_sha256"
    assert spark_result(alignment.aligned_tokens(documents([(5, None)]), BYTES, PIECES)) == [(5, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("ab \n", max_size=60), st.text("the é▁=0日😀", max_size=60)), max_size=8))
def test_groups_of_any_text(libraries, texts):
    found = alignment.aligner(BYTES, PIECES).align(*flat(pa.array(texts, pa.string()))).to_pylist()
    for row, wanted in zip(found, plain_rows(libraries, list(enumerate(texts)))):
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups_sha256"]) == (*wanted[1:5], wanted[7])


def test_stretches_of_the_dictionaries(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SPAN", 7)
    texts = ["some longer text with several words, Ünïcode and 12345 numbers", "", "short", "日本語 text"]
    found = alignment.aligner(BYTES, PIECES).align(*flat(pa.array(texts, pa.string()))).to_pylist()
    for row, wanted in zip(found, plain_rows(libraries, list(enumerate(texts)))):
        assert (row["n_groups"], row["groups_sha256"]) == (wanted[3], wanted[7])
