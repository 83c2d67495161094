"""Named numpy arrays in one file of the shared folder, read through a memory map."""

from __future__ import annotations

import functools
import json
import uuid

import numpy as np
from pyarrow import fs

_ALIGN = 64


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def save_bytes(uri: str, data: bytes) -> None:
    """Write under another name, then rename: a task that runs again replaces the whole file."""
    where, path = _place(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(draft) as out:
        out.write(data)
    where.move(draft, path)


def load_bytes(uri: str) -> bytes:
    where, path = _place(uri)
    with where.open_input_stream(path) as f:
        return f.read()


def save_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write under another name, then rename: a task that runs again replaces the whole file."""
    where, path = _place(uri)
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, a.shape, at]
        at += -(-a.nbytes // _ALIGN) * _ALIGN
    text = json.dumps(head).encode()
    where.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(draft) as out:
        start = -(-(len(text) + 8) // _ALIGN) * _ALIGN
        out.write((len(text).to_bytes(8, "little") + text).ljust(start, b"\0"))
        for a in arrays.values():
            raw = np.ascontiguousarray(a).tobytes()
            out.write(raw.ljust(-(-len(raw) // _ALIGN) * _ALIGN, b"\0"))
    where.move(draft, path)


@functools.lru_cache(maxsize=100_000)
def open_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file; a local or mounted file is mapped, any other is read once."""
    where, path = _place(uri)
    if isinstance(where, fs.LocalFileSystem):
        raw = np.asarray(np.memmap(path, np.uint8, "r"))
    else:
        with where.open_input_stream(path) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    start = -(-(size + 8) // _ALIGN) * _ALIGN
    out = {}
    for name, (kind, shape, at) in json.loads(raw[8:8 + size].tobytes()).items():
        count = int(np.prod(shape))
        out[name] = raw[start + at:start + at + count * np.dtype(kind).itemsize].view(kind).reshape(shape)
    return out
