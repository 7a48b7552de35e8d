"""Files of own formats in the shared folder, on any store pyarrow knows.

Tasks write under names of their own and report them in their rows, so what a lost
or repeated task left behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def new_file(folder: str, label: str, suffix: str) -> str:
    return f"{folder}/{label}-{uuid.uuid4().hex}{suffix}"


class Output:
    """A file that is written front to back; `at` is the next offset."""

    def __init__(self, uri: str):
        system, path = store(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.at, self._out = uri, 0, system.open_output_stream(path, compression=None)

    def write(self, data: bytes) -> int:
        start = self.at
        self._out.write(data)
        self.at += len(data)
        return start

    def close(self) -> None:
        self._out.close()


class Ranges:
    """Range reads from the file last asked for."""

    def __init__(self) -> None:
        self.uri, self._file = None, None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        self._open(uri)
        self._file.seek(offset)
        return self._file.read(length)

    def size(self, uri: str) -> int:
        self._open(uri)
        return self._file.size()

    def _open(self, uri: str) -> None:
        if uri != self.uri:
            self.close()
            system, path = store(uri)
            self.uri, self._file = uri, system.open_input_file(path)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self.uri, self._file = None, None
