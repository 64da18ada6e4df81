"""Files that tasks write and read themselves, below a folder all executors share.

A file is written under a temporary name of its own attempt and renamed when it is
complete, so a task that runs again replaces its file by an equal one and readers,
who go by the manifest, never see a part of a file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class PendingFile:
    """A stream to ``uri`` that exists under its name only after ``commit``."""

    def __init__(self, uri: str):
        self.uri = uri
        self.store, self.path = open_store(uri)
        folder, _, name = self.path.rpartition("/")
        self.store.create_dir(folder, recursive=True)
        self.temporary = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
        self.stream = self.store.open_output_stream(self.temporary)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.stream.close()
        self.store.move(self.temporary, self.path)


def open_input(uri: str):
    store, path = open_store(uri)
    return store.open_input_file(path)
