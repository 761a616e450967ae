"""Arrays in the shared folder: written whole by tasks, memory-mapped by workers.

A path is one that Spark made (``workspace.new_path``). A folder every machine sees as a file system is mapped in place;
from any other store a worker fetches an array once into an unlinked file of its own, so nothing stays behind.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow.fs


def _place(path: str):
    scheme, _, rest = path.partition(":")
    if path.startswith("/"):
        return None, path
    if scheme == "file":
        return None, "/" + rest.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def save(path: str, name: str, array: np.ndarray) -> None:
    """Write an array under a name; a task that runs twice replaces the file by the same content at once."""
    store, folder = _place(path)
    last = f".{name}-{uuid.uuid4().hex}"
    if store is None:
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{last}", "wb") as out:
            out.write(np.ascontiguousarray(array).tobytes())
        os.replace(f"{folder}/{last}", f"{folder}/{name}")
        return
    store.create_dir(folder, recursive=True)
    with store.open_output_stream(f"{folder}/{last}") as out:
        out.write(np.ascontiguousarray(array).tobytes())
    store.move(f"{folder}/{last}", f"{folder}/{name}")


def load(path: str, name: str, dtype) -> np.ndarray:
    """The array, memory-mapped; empty if it was never written."""
    store, folder = _place(path)
    if store is None:
        file = f"{folder}/{name}"
        if not os.path.exists(file) or not os.path.getsize(file):
            return np.zeros(0, dtype)
        return np.memmap(file, dtype, mode="r")
    info = store.get_file_info(f"{folder}/{name}")
    if info.type == pyarrow.fs.FileType.NotFound or not info.size:
        return np.zeros(0, dtype)
    with tempfile.TemporaryFile() as own:
        with store.open_input_stream(f"{folder}/{name}") as source:
            shutil.copyfileobj(source, own, 1 << 20)
        own.flush()
        return np.memmap(own, dtype, mode="r")
