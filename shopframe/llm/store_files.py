"""Arrays in the cluster's shared folder that tasks write once and memory-map.

A folder on a file system that all machines mount is mapped in place. Any other
store is read through pyarrow's file systems into the task's own temporary
folder, mapped there, and unlinked at once, so nothing is left behind.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np


def _local(folder: str) -> str | None:
    u = urlparse(folder)
    return u.path if u.scheme in ("", "file") else None


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Writes an array under a name; a task that is run again replaces it whole."""
    if (path := _local(folder)) is not None:
        os.makedirs(path, exist_ok=True)
        new = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(new, "wb") as f:
            np.save(f, array)
        os.replace(new, f"{path}/{name}.npy")
        return
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    new = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(new) as f:
        np.save(f, array)
    store.move(new, f"{path}/{name}.npy")


def mapped(folder: str, name: str) -> np.ndarray:
    """The array, memory-mapped."""
    if (path := _local(folder)) is not None:
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(folder)
    with tempfile.NamedTemporaryFile(suffix=".npy") as f:
        with store.open_input_stream(f"{path}/{name}.npy") as g:
            while data := g.read(1 << 22):
                f.write(data)
        f.flush()
        return np.load(f.name, mmap_mode="r")
