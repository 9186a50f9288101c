"""Files in the shared folder, written and read by tasks through Arrow's file systems (local, HDFS, object stores)."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def put(uri: str, parts: list[bytes]) -> None:
    """Writes a file under another name and then moves it to its own: a task that is lost or runs twice leaves no half file. A name stands for its content, so one
    that is there already stays, as some file systems refuse to move onto it."""
    where, path = opened(uri)
    folder, name = os.path.split(path)
    where.create_dir(folder, recursive=True)
    own = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with where.open_output_stream(own, compression=None) as out:
        for p in parts:
            out.write(p)
    if where.get_file_info(path).type != fs.FileType.File:
        try:
            where.move(own, path)
            return
        except OSError:  # another attempt may have been first
            if where.get_file_info(path).type != fs.FileType.File:
                raise
    where.delete_file(own)


def exists(uri: str) -> bool:
    where, path = opened(uri)
    return where.get_file_info(path).type == fs.FileType.File


def drop(uri: str) -> None:
    where, path = opened(uri)
    if where.get_file_info(path).type == fs.FileType.File:
        where.delete_file(path)


class Reader:
    """Range reads; keeps the ``MOST`` files open that were read last."""

    MOST = 16

    def __init__(self):
        self.files: dict[str, object] = {}

    def read(self, uri: str, offset: int, length: int) -> bytes:
        file = self.files.pop(uri, None)
        if file is None:
            if len(self.files) >= self.MOST:
                self.files.pop(next(iter(self.files))).close()
            where, path = opened(uri)
            file = where.open_input_file(path)
        self.files[uri] = file
        file.seek(offset)
        return file.read(length)

    def close(self) -> None:
        for file in self.files.values():
            file.close()
        self.files.clear()
