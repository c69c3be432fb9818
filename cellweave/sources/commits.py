"""Writes of files in two phases: tasks write under a temporary name, a commit of the whole write gives them theirs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSourceWriter, WriterCommitMessage


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def listed(uri: str, pattern: str) -> list[str]:
    """The files of a folder that fit a pattern and are not hidden, or the file itself."""
    files, root = opened(uri)
    info = files.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(root)
    return [root] if info.is_file else sorted(f.path for f in files.get_file_info(fs.FileSelector(root)) if f.is_file and re.search(pattern, f.base_name, re.I) and not f.base_name.startswith(("_", ".")))


@dataclass
class Written(WriterCommitMessage):
    """Temporary and final names of a task's files."""

    files: list[tuple[str, str]]


class TwoPhaseWriter(DataSourceWriter):
    """Files are made by `made`; those of failed and repeated tasks stay out and are removed with the temporary folder."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.options, self.overwrite, self.run = options, overwrite, uuid.uuid4().hex

    def made(self, rows: Iterator[Row]) -> Iterator[tuple[str, bytes]]:
        """Final name and bytes of each file of a task."""
        raise NotImplementedError

    def write(self, iterator: Iterator[Row]) -> Written:
        files, root = opened(self.options["path"])
        files.create_dir(f"{root}/_temporary-{self.run}", recursive=True)
        out = []
        for name, data in self.made(iterator):
            held = f"_temporary-{self.run}/{uuid.uuid4().hex}"
            with files.open_output_stream(f"{root}/{held}", compression=None) as stream:
                stream.write(data)
            out.append((held, name))
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = opened(self.options["path"])
        made = [f for m in messages if m for f in m.files]
        if self.overwrite and files.get_file_info(root).type == fs.FileType.Directory:
            kept = {name for _, name in made}
            for f in files.get_file_info(fs.FileSelector(root)):
                if f.is_file and f.base_name not in kept:
                    files.delete_file(f.path)
        for held, name in made:
            files.move(f"{root}/{held}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = opened(self.options["path"])
        if files.get_file_info(f"{root}/_temporary-{self.run}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/_temporary-{self.run}")
