"""One file per row, written by the tasks that hold the rows: no folder per document, no driver loop."""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "document_files"
DONE = "_SUCCESS"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """A path or URI as a file system of Arrow and the path in it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def checked_name(name: str | None) -> str:
    if not name or "/" in name or "\0" in name or name in (".", "..") or name.startswith(("_", ".")):
        raise ValueError(f"no name for a file: {name!r}")
    return name


def subfolders(number: int) -> list[str]:
    """Names of the folders that files are dealt to; of none, the folder itself."""
    return [f"{i:04x}" for i in range(number)] or [""]


def within(folder: str, own: str) -> str:
    return posixpath.join(folder, own) if own else folder


@dataclass
class Written(WriterCommitMessage):
    files: int
    size: int


class FileWriter(DataSourceArrowWriter):
    """Files have the names of their rows, so an attempt that is repeated, or runs twice at a time,
    writes the same files again, each replaced at once. What is complete has a marker, written when
    all tasks have ended: number of files, bytes and folders. Rows that share a name are found out then."""

    def __init__(self, path: str, overwrite: bool, folders: int = 0):
        self.path, self.job, self.folders = path.rstrip("/"), uuid.uuid4().hex, subfolders(folders)
        fs, folder = open_folder(self.path)
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        there = [f for f in found if f.is_file or f.base_name in self.folders]
        if there and not overwrite:
            raise ValueError(f"{path} is not empty")
        if overwrite and there:
            fs.delete_dir_contents(folder)
        for own in self.folders:
            fs.create_dir(within(folder, own), recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_folder(self.path)
        files = size = 0
        whole = fs.type_name in ("local", "hdfs")  # elsewhere an object appears when it is closed
        for batch in iterator:
            for cell, content in zip(batch.column(0), batch.column(1), strict=True):
                name = checked_name(cell.as_py())
                own = within(folder, self.folders[zlib.crc32(name.encode()) % len(self.folders)])
                final = posixpath.join(own, name)
                data = content.as_buffer()
                target = posixpath.join(own, f".{self.job}-{uuid.uuid4().hex}") if whole else final
                with fs.open_output_stream(target) as out:
                    if data is not None:
                        out.write(data)
                if whole:
                    fs.move(target, final)
                files += 1
                size += data.size if data is not None else 0
        return Written(files, size)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = open_folder(self.path)
        wanted = sum(m.files for m in messages if m)
        # One folder after the other: at no time is more than one listing held.
        found = sum(len(visible(fs, within(folder, own))) for own in self.folders)
        if found != wanted:
            raise RuntimeError(f"{wanted} rows made {found} files in {self.path}: names are not unique")
        with fs.open_output_stream(posixpath.join(folder, DONE)) as out:
            size = sum(m.size for m in messages if m)
            out.write(json.dumps({"files": wanted, "bytes": size, "folders": sum(map(bool, self.folders))}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = open_folder(self.path)
        for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if f.is_file:
                fs.delete_file(f.path)
            elif f.base_name in self.folders:
                fs.delete_dir(f.path)


def visible(fs: pafs.FileSystem, folder: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(folder))
    return [f.base_name for f in found if f.is_file and not f.base_name.startswith((".", "_"))]


class DocumentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file_name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"], overwrite, int(self.options.get("folders", 0)))


def write_files(df: DataFrame, path: str, name: str = "file_name", content: str = "content", folders: int = 0) -> None:
    """A file for each row, named by one column, with the text or bytes of another; null is an empty
    file. The folder's earlier files go. Names must be unique and not hidden. The folder is one that
    tasks reach through Arrow's file systems: local, HDFS or an object store. For millions of files,
    ``folders`` deals them to as many folders below it by a hash of the name, so that nobody has to
    hold the names of all; :func:`docmart.sources.corpus.scan_files` reads either form."""
    df.sparkSession.dataSource.register(DocumentFiles)
    rows = df.select(F.col(name).alias("file_name"), F.col(content).cast("binary").alias("content"))
    rows.write.format(FORMAT).mode("overwrite").option("folders", folders).save(path)


def is_complete(path: str) -> bool:
    fs, folder = open_folder(path.rstrip("/"))
    return fs.get_file_info(posixpath.join(folder, DONE)).is_file


def folders_of(path: str) -> list[str]:
    """The folders of a complete folder of files, by its marker."""
    fs, folder = open_folder(path.rstrip("/"))
    if not is_complete(path):
        raise ValueError(f"{path} is not complete")
    with fs.open_input_stream(posixpath.join(folder, DONE)) as marker:
        return subfolders(json.loads(marker.read()).get("folders", 0))
