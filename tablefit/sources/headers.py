"""First lines of files as a Spark source.

``spark.read.format("first_lines")`` lists directories, deals their files into
partitions of ``filesPerPartition``, and yields one row a file: ``file, line``,
where ``line`` is the first line that is not blank, null for a file without
one. A task reads no more than the first pieces of a file, however long it is.

Options: ``directories`` (a JSON list of paths), ``glob`` (of file names) and
``filesPerPartition``. Names that begin with ``_`` or ``.`` are hidden, as for
Spark's own readers; subdirectories are not entered. File systems are those
of Arrow (local and shared folders, HDFS, S3, GCS); ``can_open`` tells whether
a path is one of them. Compressed files are opened by their suffix.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PIECE = 64 * 1024


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")  # a plain path: nothing in it is encoded
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def can_open(path: str) -> bool:
    try:
        file_system(path)
    except Exception:  # noqa: BLE001  no such file system in Arrow
        return False
    return True


def wanted(name: str, glob: str) -> bool:
    return not name.startswith(("_", ".")) and fnmatchcase(name, glob)


def listed(directory: str, glob: str) -> list[str]:
    """Names of the files directly in ``directory`` that match."""
    system, path = file_system(directory)
    infos = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(i.base_name for i in infos if i.type == fs.FileType.File and wanted(i.base_name, glob))


def first_line(path: str) -> str | None:
    """The first line that is not blank; lines end in \\n, \\r or both."""
    system, inner = file_system(path)
    held = b""
    with system.open_input_stream(inner) as stream:
        while True:
            piece = stream.read(PIECE)
            held += piece
            lines = held.replace(b"\r", b"\n").split(b"\n")
            for line in lines if not piece else lines[:-1]:
                text = line.decode("utf-8", "replace")
                if text.strip("﻿ \t"):
                    return text
            if not piece:
                return None
            held = lines[-1]


@dataclass
class FileGroup(InputPartition):
    files: Sequence[str]


class FirstLineReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.directories = json.loads(options.get("directories", "[]"))
        self.glob = options.get("glob", "*")
        self.size = int(options.get("filesPerPartition", "100"))

    def partitions(self) -> list[FileGroup]:
        files = [f"{d.rstrip('/')}/{name}" for d in self.directories for name in listed(d, self.glob)]
        return [FileGroup(files[i : i + self.size]) for i in range(0, len(files), self.size)] or [FileGroup([])]

    def read(self, partition: FileGroup) -> Iterator[tuple]:
        for file in partition.files:
            yield file, first_line(file)


class FirstLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "first_lines"

    def schema(self) -> str:
        return "file string, line string"

    def reader(self, schema) -> FirstLineReader:
        return FirstLineReader(self.options)
