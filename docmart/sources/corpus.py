"""Document sources. A corpus is a DataFrame ``file_name string, xml string``."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.sources.files import folders_of, open_folder, visible, within

CORPUS_SCHEMA = "file_name string, xml string"
LISTING = "file_name string, length long, hidden boolean"


def scan_directory(spark: SparkSession, path: str, require: bool = False) -> DataFrame:
    """One document per ``*.xml`` file of a folder: not recursive, suffix case-sensitive.

    The folder is listed by a task (:func:`list_documents`), the names are dealt to tasks by
    :func:`spread`, and each task reads its files: neither the names nor the contents pass
    through the driver, and a task holds a bounded share of the contents at a time. Files that
    the file source would pass over in silence come back without content, so that they end up
    in the quarantine: empty ones as ``''``, names with a leading dot or underscore as null.
    Bytes become text as the text source makes them. On file systems that only Hadoop knows,
    the text source reads the folder.
    ``require`` raises where the folder holds no document.

    A corpus of very many documents belongs into :func:`scan_packed`, or into files of many
    documents (:func:`docmart.operators.parse.read_documents`).
    """
    if _listed_in_tasks(path):
        read = _read_listed(spread(list_documents(spark, path), "file_name"), path)
        corpus = read.select("file_name", F.col("content").cast("string").alias("xml"))
    else:
        files = spark.read.text(path, wholetext=True, pathGlobFilter="*.xml", recursiveFileLookup=False)
        # The metadata column holds the name as in a URI, where '+' stands for itself.
        name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
        corpus = files.select(name.alias("file_name"), F.col("value").alias("xml"))
        passed_over = list_documents(spark, path).where("hidden OR length = 0")
        corpus = corpus.union(passed_over.select("file_name", F.when(~F.col("hidden"), F.lit("")).alias("xml")))
    if require and list_documents(spark, path).isEmpty():
        raise ValueError(f"no *.xml documents in {path}")
    return corpus


def list_documents(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, length, hidden`` of the ``*.xml`` files of a folder; no file is opened.

    Spark's own listing leaves out empty and hidden files (leading dot or underscore). Here a task
    lists the folder through Arrow's file systems and sends rows, so the driver holds none of it.
    File systems that only Hadoop knows are listed by the driver.
    """
    if not _listed_in_tasks(path):
        return spark.createDataFrame(_listed_by_driver(spark, path), LISTING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                fs, own = open_folder(folder)
                found = [f for f in fs.get_file_info(pafs.FileSelector(own, allow_not_found=True)) if f.is_file and f.base_name.endswith(".xml")]
                for i in range(0, len(found), 50_000):
                    yield _listing((f.base_name, f.size) for f in found[i : i + 50_000])

    return spark.createDataFrame([(path,)], "folder string").mapInArrow(run, LISTING)


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, content`` of the files that :func:`docmart.sources.files.write_files` left, empty ones too.

    Tasks list the folders, a folder at a time, the names are dealt to tasks by :func:`spread`, and
    each task reads its files: the driver reads the marker only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(path.rstrip("/"))
        for batch in batches:
            for own in batch.column(0).to_pylist():
                names = visible(fs, within(folder, own))
                for i in range(0, len(names), 50_000):
                    yield _listing((posixpath.join(own, n), 0) for n in names[i : i + 50_000])

    listing = spark.createDataFrame([(own,) for own in folders_of(path)], "folder string").mapInArrow(run, LISTING)
    read = _read_listed(spread(listing, "file_name"), path)
    return read.select(F.element_at(F.split("file_name", "/"), -1).alias("file_name"), "content")


def _listed_in_tasks(path: str) -> bool:
    try:
        open_folder(path)
    except (pa.ArrowException, ValueError, NotImplementedError):
        return False
    return True


def _read_listed(listing: DataFrame, path: str, chunk_bytes: int = 64 << 20) -> DataFrame:
    """``file_name, content`` of listed files, read by the tasks that hold their rows; hidden ones
    without content. A task sends what it has read in chunks of about ``chunk_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(path)
        names: list[str] = []
        contents: list[bytes | None] = []
        held = 0
        for batch in batches:
            for name, hidden in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = None
                if not hidden:
                    with fs.open_input_stream(posixpath.join(folder, name)) as f:
                        data = f.read()
                names.append(name)
                contents.append(data)
                held += len(data or b"")
                if held >= chunk_bytes:
                    yield pa.record_batch([pa.array(names, pa.string()), pa.array(contents, pa.binary())], names=["file_name", "content"])
                    names, contents, held = [], [], 0
        if names:
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(contents, pa.binary())], names=["file_name", "content"])

    return listing.select("file_name", "hidden").mapInArrow(run, "file_name string, content binary")


def _listing(files: Iterable[tuple[str, int]]) -> pa.RecordBatch:
    rows = [(name, size, name.startswith((".", "_"))) for name, size in files]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    types = (pa.string(), pa.int64(), pa.bool_())
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file_name", "length", "hidden"])


def _listed_by_driver(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(folder) if f.isFile()]
    return [(name, size, name.startswith((".", "_"))) for name, size in found if name.endswith(".xml")]


def scan_packed(spark: SparkSession, path: str) -> DataFrame:
    """A corpus stored as Parquet: the layout for corpora of very many documents."""
    return spark.read.schema(CORPUS_SCHEMA).parquet(path)


def spread(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Deal the rows to ``tasks`` tasks (default: ``spark.sql.shuffle.partitions``) by a hash of
    ``key``, which must be unique or nearly so. For compact rows that grow in what follows."""
    return df.repartition(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def count_documents(corpus: DataFrame) -> DataFrame:
    return corpus.agg(F.count(F.lit(1)).alias("n_documents"))


def count_files(spark: SparkSession, path: str) -> DataFrame:
    """Number of documents in a folder: those the source reads and those it passes over. No file is
    opened."""
    return count_documents(list_documents(spark, path))
