"""Files of modules: one text file per (module, file name), in one job.

``module_files`` is a Python data source.  Written rows are (module, file,
line); rows of one file must be consecutive in one partition, in the order of
its lines.  A task streams its rows into files of its own attempt in a
staging folder; nothing is visible before the job commits.  The commit first
gathers every finished file of a module, then puts the whole module in place of
the old one, so files that are no longer written disappear and a failed job
leaves the earlier files alone.  Read rows are (module, file, line_no, line).

Paths go through ``pyarrow.fs``: a plain path, ``file:``, ``hdfs:`` or ``s3:``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

STAGING = "_staging"
#: files of one read task
FILES_PER_TASK = 64


def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///", 1))
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, str]]  # (module, file, staged path)


def _name(text: str, what: str) -> str:
    if not text or "/" in text or text in (".", "..") or text.startswith(STAGING):
        raise ValueError(f"not a {what} name: {text!r}")
    return text


class FilesWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def _staging(self) -> str:
        return f"{self.path}/{STAGING}-{self.job}"

    def write(self, rows: Iterator[Row]) -> Written:
        fs, base = _filesystem(self._staging())
        attempt = f"{base}/{uuid.uuid4().hex}"
        files: list[tuple[str, str, str]] = []
        at, out, done = None, None, set()
        try:
            for module, file, line in rows:
                if (module, file) != at:
                    if out is not None:
                        out.close()
                    at = (_name(module, "module"), _name(file, "file"))
                    if at in done:
                        raise ValueError(f"rows of {module}/{file} are not together")
                    done.add(at)
                    folder = f"{attempt}/{module}"
                    fs.create_dir(folder, recursive=True)
                    files.append((module, file, f"{folder}/{file}"))
                    out = fs.open_output_stream(f"{folder}/{file}")
                out.write(line.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, staging = _filesystem(self._staging())
        _, base = _filesystem(self.path)
        seen: set[tuple[str, str]] = set()
        modules: set[str] = set()
        for module, file, staged in (f for m in messages if m is not None for f in m.files):
            if (module, file) in seen:
                self.abort(messages)
                raise ValueError(f"two tasks wrote {module}/{file}")
            seen.add((module, file))
            if module not in modules:
                fs.create_dir(f"{staging}/whole/{module}", recursive=True)
                modules.add(module)
            fs.move(staged, f"{staging}/whole/{module}/{file}")
        from pyarrow.fs import FileType

        for module in sorted(modules):
            final = f"{base}/{module}"
            if fs.get_file_info(final).type != FileType.NotFound:
                fs.create_dir(f"{staging}/old", recursive=True)
                fs.move(final, f"{staging}/old/{module}")
            fs.move(f"{staging}/whole/{module}", final)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow.fs import FileType

        fs, staging = _filesystem(self._staging())
        if fs.get_file_info(staging).type != FileType.NotFound:
            fs.delete_dir(staging)


@dataclass
class Files(InputPartition):
    files: tuple[tuple[str, str, str], ...] = ()


class FilesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def partitions(self) -> list[Files]:
        from pyarrow.fs import FileSelector, FileType

        fs, base = _filesystem(self.path)
        found = []
        for info in fs.get_file_info(FileSelector(base, recursive=True)):
            parts = info.path[len(base):].strip("/").split("/")
            if info.type == FileType.File and len(parts) == 2 and not parts[0].startswith(STAGING):
                found.append((*parts, info.path))
        found.sort()
        return [Files(tuple(found[i:i + FILES_PER_TASK])) for i in range(0, len(found), FILES_PER_TASK)] or [Files()]

    def read(self, partition: Files) -> Iterator[tuple]:
        import io

        fs, _ = _filesystem(self.path)
        for module, file, path in partition.files:
            with fs.open_input_stream(path) as raw:
                for i, line in enumerate(io.TextIOWrapper(raw, "utf-8", newline="\n")):
                    yield module, file, i, line.removesuffix("\n")


class ModuleFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "module_files"

    def schema(self) -> str:
        return "module string, file string, line_no long, line string"

    def reader(self, schema: StructType) -> FilesReader:
        return FilesReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options["path"])


def write_module_files(lines: DataFrame, path: str) -> None:
    """``lines`` (module, file, line), files whole and ordered in a partition,
    written below ``path``; every module that occurs is replaced."""
    lines.sparkSession.dataSource.register(ModuleFiles)
    lines.select("module", "file", "line").write.format("module_files").mode("append").save(path)


def read_module_files(spark: SparkSession, path: str) -> DataFrame:
    """(module, file, line_no, line) of every file below ``path``."""
    spark.dataSource.register(ModuleFiles)
    return spark.read.format("module_files").load(path)
