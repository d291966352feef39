"""Number arrays packed into one binary value, for shuffles of many numbers."""

import numpy as np
import zstandard

_packer = zstandard.ZstdCompressor(level=1)
_unpacker = zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Byte planes of each array, compressed together: the high bytes of small
    numbers and of small differences cost next to nothing."""
    head = [len(arrays).to_bytes(1, "little")]
    body = []
    for array in arrays:
        array = np.ascontiguousarray(array)
        head += [array.dtype.str.encode().ljust(4), len(array).to_bytes(8, "little")]
        body.append(array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes())
    return b"".join(head) + _packer.compress(b"".join(body))


def unpack(data: bytes) -> list[np.ndarray]:
    count, arrays = data[0], []
    plain = np.frombuffer(_unpacker.decompress(data[1 + 12 * count:]), np.uint8)
    at = 0
    for i in range(count):
        entry = data[1 + 12 * i: 13 + 12 * i]
        kind, size = np.dtype(entry[:4].strip().decode()), int.from_bytes(entry[4:], "little")
        planes = plain[at: at + size * kind.itemsize].reshape(kind.itemsize, size)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * kind.itemsize
    return arrays


def steps(ascending: np.ndarray) -> np.ndarray:
    """An ascending array as its first value and the differences."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def smallest(values: np.ndarray) -> np.ndarray:
    """The same non-negative numbers in the narrowest unsigned type."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))
