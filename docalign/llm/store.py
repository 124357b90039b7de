"""Files of bytes in the shared folder, for tasks that write or read them in pieces."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


class Files:
    """A folder of byte files, addressed by URI or absolute path."""

    def __init__(self, folder: str) -> None:
        self.system, self.folder = fs.FileSystem.from_uri(folder)

    def make(self) -> None:
        self.system.create_dir(self.folder, recursive=True)

    def write(self, name: str, parts) -> int:
        """Write a file whole or not at all: a repeated task replaces it by equal bytes."""
        hidden = f"{self.folder}/_{name}.{uuid.uuid4().hex}"
        size = 0
        with self.system.open_output_stream(hidden) as out:
            for part in parts:
                out.write(part)
                size += len(part)
        self.system.move(hidden, f"{self.folder}/{name}")
        return size

    def read(self, name: str, start: int = 0, size: int | None = None) -> pa.Buffer:
        """Bytes of a file from ``start`` on."""
        with self.system.open_input_file(f"{self.folder}/{name}") as file:
            return file.read_at(file.size() - start if size is None else size, start)
