"""A sink of files: rows of (path, content) become files of a folder when the whole job has succeeded."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written: names in the folder, and the digests that its staged files are named by."""

    files: list[tuple[str, str]]


class PathConflict(ValueError):
    """Rows of one job give one path different contents."""


def plain_name(path: str) -> str:
    parts = path.split("/")
    if not path or path.startswith("/") or any(p in ("", ".", "..", "_staged") for p in parts):
        raise ValueError(f"no relative path of a file: {path!r}")
    return path


class FileWriter(DataSourceWriter):
    """Tasks write contents to <folder>/_staged/<job>/<digest>, so that a task that is run again writes the same files.

    commit() moves them to their names; a name that is taken keeps its file. It can be repeated: what it has moved is
    found under its name. abort() removes what was staged, so a failed job leaves nothing.
    """

    def __init__(self, folder: str) -> None:
        self.folder, self.job = folder.rstrip("/"), uuid.uuid4().hex

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder.removeprefix("file:"))

    def write(self, iterator: Iterator[Row]) -> Staged:
        system, root = self._at()
        staged, out = f"{root}/_staged/{self.job}", []
        system.create_dir(staged, recursive=True)
        for r in iterator:
            if r["path"] is None or r["content"] is None:
                continue
            content = bytes(r["content"])
            digest = hashlib.sha256(content).hexdigest()
            with system.open_output_stream(f"{staged}/{digest}.{uuid.uuid4().hex}") as f:
                f.write(content)
            out.append((plain_name(r["path"]), digest))
        return Staged(out)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = self._at()
        staged, wanted = f"{root}/_staged/{self.job}", {}
        for path, digest in (f for m in messages if m is not None for f in m.files):
            if wanted.setdefault(path, digest) != digest:
                self.abort(messages)
                raise PathConflict(f"{path} has different contents")
        held = {i.base_name.partition(".")[0]: i.path for i in system.get_file_info(fs.FileSelector(staged, allow_not_found=True)) if i.is_file}
        for path, digest in sorted(wanted.items()):
            to = f"{root}/{path}"
            if system.get_file_info(to).type == fs.FileType.NotFound and digest in held:
                if "/" in path:
                    system.create_dir(to.rpartition("/")[0], recursive=True)
                # Two names of one content are two files.
                system.copy_file(held[digest], f"{to}.part-{self.job}")
                system.move(f"{to}.part-{self.job}", to)
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        system, root = self._at()
        if system.get_file_info(f"{root}/_staged/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_staged/{self.job}")


class FileSink(DataSource):
    """df.write.format("files").option("folder", ...).mode("append").save(): columns path and content; null ones are left out.

    The folder must be one that all executors and the driver share. A path that exists keeps its file, so writing the
    same rows again changes nothing; rows of one path and different contents fail the job before any file is there.
    """

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema: Any, overwrite: bool) -> FileWriter:
        if overwrite:
            raise ValueError("files are only added")
        return FileWriter(self.options["folder"])
