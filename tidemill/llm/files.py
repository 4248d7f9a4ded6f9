"""Files that tasks write and read themselves, in the shared folder of the cluster.

The folder is the one in ``spark.checkpoint.dir``; any store that Arrow can open will do. Every
attempt of a task writes a file of its own name. The names that count are those in the rows the
successful attempts returned, so a repeated or speculative attempt leaves at most an unused file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and the folder's path in it."""
    return fs.FileSystem.from_uri(folder)


def new_name(kind: str, number: int, ending: str) -> str:
    return f"{kind}-{number:06d}-{uuid.uuid4().hex[:12]}.{ending}"


class Reader:
    """Range reads from the files of one folder; the last file stays open."""

    def __init__(self, folder: str):
        self.store, self.folder = opened(folder)
        self.name, self.file = None, None

    def open(self, name: str):
        if name != self.name:
            self.close()
            self.file, self.name = self.store.open_input_file(f"{self.folder}/{name}"), name
        return self.file

    def read(self, name: str, offset: int, length: int) -> bytes:
        file = self.open(name)
        file.seek(offset)
        data = file.read(length)
        if len(data) != length:
            raise OSError(f"{name} ends before {offset + length}")
        return data

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = self.name = None
