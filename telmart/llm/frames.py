"""Files of independent zstandard frames with a trailing seek table.

The layout is zstandard's public seekable format: data frames, then a skippable
frame with each frame's compressed size, plain size and checksum (the low 32
bits of XXH64 over the plain bytes), and a footer with the number of frames. A
plain zstandard reader reads the whole file; a seeking reader fetches the table
from the end and then decompresses only the frames it needs.
"""

import os
import uuid
from contextlib import contextmanager

import numpy as np
import xxhash
import zstandard

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])


class FrameWriter:
    def __init__(self, stream, level: int = 3):
        self._stream = stream
        self._packer = zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []

    def add(self, plain: bytes) -> int:
        """Writes one frame and returns its number."""
        packed = self._packer.compress(plain)
        self._stream.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def finish(self) -> None:
        table = np.array(self.entries, ENTRY).tobytes()
        footer = (
            len(self.entries).to_bytes(4, "little") + bytes([CHECKSUM_FLAG])
            + SEEK_TABLE_MAGIC.to_bytes(4, "little")
        )
        size = len(table) + len(footer)
        self._stream.write(SKIPPABLE_MAGIC.to_bytes(4, "little") + size.to_bytes(4, "little") + table + footer)


class FrameReader:
    """Random access to the frames of a file that can seek."""

    def __init__(self, stream, size: int):
        self._stream = stream
        footer = self._at(size - 9, 9)
        if int.from_bytes(footer[5:], "little") != SEEK_TABLE_MAGIC:
            raise ValueError("no seek table at the end of the file")
        count = int.from_bytes(footer[:4], "little")
        self.table = np.frombuffer(self._at(size - 9 - count * ENTRY.itemsize, count * ENTRY.itemsize), ENTRY)
        self._starts = np.concatenate([[0], np.cumsum(self.table["packed"].astype(np.int64))])
        self._unpacker = zstandard.ZstdDecompressor()

    def _at(self, position: int, size: int) -> bytes:
        self._stream.seek(position)
        return self._stream.read(size)

    def __len__(self) -> int:
        return len(self.table)

    def frame(self, number: int) -> bytes:
        entry = self.table[number]
        packed = self._at(int(self._starts[number]), int(entry["packed"]))
        plain = self._unpacker.decompress(packed, max_output_size=int(entry["plain"]))
        if len(plain) != entry["plain"] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"frame {number} is damaged")
        return plain


@contextmanager
def created(files, path: str):
    """A file that appears under its name only when it is complete, so that a
    lost or repeated task leaves no half file."""
    folder, name = os.path.split(path)
    files.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as stream:
        yield stream
    files.move(draft, path)


@contextmanager
def opened(files, path: str):
    with files.open_input_file(path) as stream:
        yield FrameReader(stream, stream.size())
