"""Web pages as WARC records in seekable zstandard bundles.

A bundle is a file of independent frames with a trailing seek table (see
frames.py); each frame holds whole records, some FRAME_BYTES of them. The last
frame is the index that maps each record's page to its frame and its place
there, so a reader decompresses one frame to fetch a record.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from telmart.llm.frames import FrameReader, FrameWriter, created, opened
from telmart.llm.shared import open_folder, written

SMALLEST_REVISIT = 100
FRAME_BYTES = 1 << 20
# Fixed values of the record format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
INDEX = np.dtype([("known", "u1"), ("page", "<i8"), ("frame", "<u4"), ("at", "<u8"), ("size", "<u8")])


def _urn(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def _safe(url: str) -> str:
    """A header value: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = NO_DATE) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP
    headers only. The HTTP headers state the full payload's length."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _safe(url)))
    if revisit:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in headers)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:stop].decode().split("\r\n")
        if first.encode() != VERSION:
            raise ValueError(f"no record begins at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        begin = stop + 4
        end = begin + int(headers["Content-Length"])
        if data[end: end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield headers, data[begin:end]
        at = end + 4


def described(headers: dict[str, str], block: bytes) -> dict:
    """What a record says about its page; a response's payload is measured and
    its digest verified."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    if headers["WARC-Type"] == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    return {
        "page_id": _page(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": _page(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None,
        "payload": payload if headers["WARC-Type"] == "response" else None,
    }


def _write_bundle(files, path: str, rows: Iterator[dict]) -> tuple[int, int]:
    index, frame, held = [], [], 0
    with created(files, path) as stream:
        frames = FrameWriter(stream)
        for row in rows:
            data = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
            index.append((row["page_id"] is not None, row["page_id"] or 0, len(frames.entries), held, len(data)))
            frame.append(data)
            held += len(data)
            if held >= FRAME_BYTES:
                frames.add(b"".join(frame))
                frame, held = [], 0
        if frame:
            frames.add(b"".join(frame))
        frames.add(np.array(index, INDEX).tobytes())
        frames.finish()
    return len(index), len(frames.entries)


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Of the pages with equal
    payloads of at least SMALLEST_REVISIT bytes the smallest identifier is the
    response, and so is every further row with that identifier; the others
    refer to it. The pages move once, by digest; a frequent payload is split by
    adaptive skew handling, and its first page was found by partial sums."""
    hashed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = hashed.where(F.octet_length("payload") >= SMALLEST_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("digest", "first")
    return hashed.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each page, one bundle per task, and returns one row
    per bundle: file, n_records, n_frames. A null html is an empty payload, a
    null url is left out, a null page_id is kept as such."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        name = f"pages-{TaskContext.get().partitionId():06d}.warc.zst"

        def rows():
            for batch in batches:
                for row in range(batch.num_rows):
                    yield batch.slice(row, 1).to_pylist()[0]

        records, frames = _write_bundle(files, f"{root}/{name}", rows())
        yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [records], "n_frames": [frames]})

    return written(
        with_references(pages).mapInArrow(write, "file string, n_records long, n_frames long"), "bundle-list"
    )


def find(reader: FrameReader, page: int | None) -> list[bytes]:
    """The records of one page; decompresses the index and their frames."""
    index = np.frombuffer(reader.frame(len(reader) - 1), INDEX)
    hits = index[(index["known"] == (page is not None)) & (index["page"] == (page or 0))]
    return [reader.frame(int(x["frame"]))[int(x["at"]): int(x["at"] + x["size"])] for x in hits]


DESCRIBED = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_bundles(spark: SparkSession, bundles: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles (columns: DESCRIBED), frame by frame.
    Without ``payloads`` that column is null, after the same checks."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with opened(files, f"{root}/{name}") as reader:
                    for frame in range(len(reader) - 1):
                        rows = [described(*x) for x in parse(reader.frame(frame))]
                        if not payloads:
                            rows = [row | {"payload": None} for row in rows]
                        yield pa.RecordBatch.from_pylist(rows, schema)

    each = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bundles.select("file").repartition(each).mapInArrow(read, DESCRIBED)
