from hashlib import sha256

import pytest
from pyarrow.fs import LocalFileSystem

from telmart.llm import frames, warc
from telmart.session import new_folder


def brute(rows):
    payloads = [(html or "").encode() for _, _, html in rows]
    out = []
    for (page, _, _), payload in zip(rows, payloads):
        same = [other for (other, _, _), x in zip(rows, payloads) if x == payload and other is not None]
        first = min(same, default=None) if len(payload) >= 100 else page
        refers = first if first is not None and first != page else None
        out.append((page, len(payload), sha256(payload).hexdigest(), "revisit" if refers is not None else "response", refers))
    return out


@pytest.fixture(scope="module")
def rows():
    page = "<p>" + "é" * 48 + "</p>"
    assert len(page.encode()) > 100
    return (
        [(i, f"http://x/{i}", page) for i in range(9, 0, -1)]
        + [(20, None, "short"), (21, "http://a b\r\nX: y", "short"), (22, "", None), (23, "http://e", ""),
           (24, "u", "x" * 99), (25, "u", "x" * 99), (26, "u", "y" * 100), (27, "u", "y" * 100),
           (28, "u", "WARC/1.1\r\n\r\n" * 40), (29, "u", "z" * 3_000_000), (3, "http://again", page),
           (None, "u", page), (None, "u", "q" * 200), (None, "u", "q" * 200)]
    )


def order(row):
    return tuple((x is None, x) for x in row)


def test_written_and_read_back(spark, rows, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 1000)
    pages = spark.createDataFrame([(*row, "clash", 1) for row in rows], "page_id long, url string, html string, payload string, n int")
    folder = new_folder(spark, "warc-test")
    bundles = warc.write_bundles(pages, folder)
    found = warc.read_bundles(spark, bundles, folder).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    for r in found:
        if r.record_type == "response":
            assert sha256(bytes(r.payload)).hexdigest() == r.payload_digest
        else:
            assert r.payload is None
    assert {r.url for r in found if r.page_id == 21} == {"http://a%20b%0D%0AX:%20y"}
    assert {r.url for r in found if r.page_id == 20} == {None}
    assert bundles.agg({"n_records": "sum"}).first()[0] == len(rows)


def test_one_record_is_found_by_its_page(tmp_path):
    files = LocalFileSystem()
    records = [{"page_id": i, "url": "u", "payload": b"x" * i, "digest": sha256(b"x" * i).hexdigest(), "refers_to": None}
               for i in (5, 3, 400_000, 7)] + [{"page_id": None, "url": None, "payload": b"", "digest": sha256(b"").hexdigest(), "refers_to": None}]
    warc._write_bundle(files, f"{tmp_path}/b", iter(records))
    with frames.opened(files, f"{tmp_path}/b") as reader:
        for page, size in ((3, 3), (7, 7), (None, 0)):
            (data,) = warc.find(reader, page)
            ((headers, block),) = warc.parse(data)
            assert warc.described(headers, block)["payload_bytes"] == size
        assert warc.find(reader, 99) == []


def test_damage_is_noticed():
    good = warc.record(1, "u", b"payload", sha256(b"payload").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        warc.described(*next(warc.parse(good.replace(b"payload\r\n", b"Payload\r\n"))))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse(b"x" + good))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = new_folder(spark, "warc-none")
    assert warc.read_bundles(spark, warc.write_bundles(pages, folder), folder).collect() == []
