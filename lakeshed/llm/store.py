"""Arrays in the shared folder, written by tasks and mapped by workers."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np


class Store:
    """Arrays in a folder that all workers see.

    A mounted path is mapped in place, so that a worker holds the pages it
    touches; from a store that isn't mounted a worker reads arrays into memory.
    An array is written under a name of its own and renamed, so that a task that
    runs again leaves the same files.
    """

    def __init__(self, folder: str):
        self.folder = folder
        url = urlparse(folder)
        self.local = url.path if url.scheme in ("", "file") else None

    def write(self, name: str, values: np.ndarray) -> None:
        own = f".{name}-{uuid.uuid4().hex}"
        if self.local:
            os.makedirs(self.local, exist_ok=True)
            values.tofile(f"{self.local}/{own}")
            os.replace(f"{self.local}/{own}", f"{self.local}/{name}")
            return
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{own}") as out:
            out.write(values.tobytes())
        system.move(f"{path}/{own}", f"{path}/{name}")

    def has(self, name: str) -> bool:
        if self.local:
            return os.path.exists(f"{self.local}/{name}")
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder)
        return system.get_file_info(f"{path}/{name}").type == fs.FileType.File

    def read(self, name: str, dtype: type) -> np.ndarray:
        if self.local:
            path = f"{self.local}/{name}"
            return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder)
        with system.open_input_file(f"{path}/{name}") as data:
            return np.frombuffer(data.read(), dtype)
