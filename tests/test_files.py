"""Sources and sinks on real folders."""

from __future__ import annotations

import csv
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmart.functions.schema import table_schema
from docmart.operators.extract import extract
from docmart.operators.parse import parse_documents, quarantine, read_documents
from docmart.plans.config import DomainConfig, Step, document_id, from_path
from docmart.session import scratch_path, work_dir
from docmart.sources import corpus, files, tables, writers

ITEMS = DomainConfig("items", (document_id(), from_path("a", "_a"), from_path("b", "_b")), (Step("i"),))


def test_directory_scan(spark, tmp_path):
    (tmp_path / "one.xml").write_text("<D/>\n<!-- two lines -->", encoding="utf-8")
    (tmp_path / "two.dots.xml").write_text("<D>é</D>", encoding="utf-8")
    (tmp_path / "with space+plus%20.xml").write_text("<D/>")
    (tmp_path / "_hidden.xml").write_text("<D/>")
    (tmp_path / ".xml").write_text("<D/>")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "UPPER.XML").write_text("<D/>")
    (tmp_path / "notes.txt").write_text("<D/>")
    (tmp_path / "nested").mkdir()
    (tmp_path / "nested" / "deep.xml").write_text("<D/>")
    found = {r["file_name"]: r["xml"] for r in corpus.scan_directory(spark, str(tmp_path)).collect()}
    assert found == {
        "one.xml": "<D/>\n<!-- two lines -->",
        "two.dots.xml": "<D>é</D>",
        "with space+plus%20.xml": "<D/>",
        "empty.xml": "",
        "_hidden.xml": None,
        ".xml": None,
    }


def test_directory_scan_lists_and_reads_in_tasks(spark, tmp_path):
    """The driver indexes none of the folder's files; tasks read them, every one once."""
    for k in range(40):
        (tmp_path / f"d{k}.xml").write_bytes(f"<D>{k}</D>".encode() if k % 7 else b"")
    (tmp_path / "_skip.xml").write_text("<D/>")
    (tmp_path / "bad.xml").write_bytes(b"<D>\xff</D>")
    scan = corpus.scan_directory(spark, str(tmp_path))
    assert scan.inputFiles() == []
    rows = scan.collect()
    assert len(rows) == 42
    found = {r["file_name"]: r["xml"] for r in rows}
    assert found == {f"d{k}.xml": f"<D>{k}</D>" if k % 7 else "" for k in range(40)} | {
        "_skip.xml": None,
        "bad.xml": spark.createDataFrame([(bytearray(b"<D>\xff</D>"),)], "b binary").selectExpr("cast(b as string)").first()[0],
    }


def test_no_documents(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    assert corpus.scan_directory(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError, match="no .*xml"):
        corpus.scan_directory(spark, str(tmp_path), require=True)


def test_files_of_many_documents(spark, tmp_path):
    text = "<all>" + "".join(f'<D><id root="x" extension="{k}"/><i a="{k}"/></D>' for k in range(50)) + "<D><i></D></all>"
    (tmp_path / "many.xml").write_text(text)
    docs = read_documents(spark, str(tmp_path), "D", "id._extension", [ITEMS])
    assert docs.columns == ["doc_id", "file_name", "doc", "error", "xml"]
    rows = extract(docs, [ITEMS]).select("doc_id", "a").collect()
    assert sorted((int(d), int(a)) for d, a in rows) == [(k, k) for k in range(50)]
    assert [r["message"] for r in quarantine(docs).collect()] == ["malformed XML: mismatched tag or bad character"]
    text_config = DomainConfig("t", (from_path("id", "id"),))
    with pytest.raises(ValueError, match="as text"):
        read_documents(spark, str(tmp_path), "D", "id._extension", [text_config])


@pytest.mark.parametrize("fault", ["a & b", "</x>", "<i>"])
def test_a_damaged_document_takes_no_other_along(spark, tmp_path, fault):
    docs = [f'<D ><id extension="{k}"/><i a="{k}"/></D\n>' for k in range(100)]
    docs[1] = f'<D><id extension="1"/>{fault}</D>'
    (tmp_path / "a b+c.xml").write_text('<?xml version="1.0"?>\n<Ds>\n' + "\n".join(docs) + "\n</Ds>")
    read = read_documents(spark, str(tmp_path), "D", "id._extension", [ITEMS])
    assert sorted(int(r["a"]) for r in extract(read, [ITEMS]).collect()) == [0, *range(2, 100)]
    bad = quarantine(read).collect()
    assert [(r["file_name"], r["xml"]) for r in bad] == [("a b+c.xml", docs[1])]


def test_a_large_file_is_split(spark, tmp_path):
    (tmp_path / "all.xml").write_text("".join(f'<D><id extension="{k}"/><i a="{k}" b="{"x" * 100}"/></D>\n' for k in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        read = read_documents(spark, str(tmp_path), "D", "id._extension", [ITEMS])
        assert read.rdd.getNumPartitions() > 10
        assert read.agg(F.countDistinct("doc_id"), F.count("*"), F.count("error")).first() == (20_000, 20_000, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_packed_corpus(spark, tmp_path):
    frame = spark.createDataFrame([("a.xml", "<D/>")], corpus.CORPUS_SCHEMA)
    writers.write_table(frame, str(tmp_path / "packed"))
    assert corpus.scan_packed(spark, str(tmp_path / "packed")).collect() == frame.collect()


def test_spread(spark):
    assert corpus.spread(spark.range(1000).coalesce(1), "id").rdd.getNumPartitions() == 4
    assert corpus.spread(spark.range(0, 1000, 1, 40), "id", 7).rdd.getNumPartitions() == 7


def test_codemap_csv(spark, tmp_path):
    (tmp_path / "map.csv").write_text('code_system,code,concept_id\nLN,"8480-6",12\nLN,"a,b",13\nLN,bad,x\n')
    rows = [tuple(r) for r in tables.read_codemap(spark, str(tmp_path / "map.csv")).collect()]
    assert rows == [("LN", "8480-6", 12), ("LN", "a,b", 13), ("LN", "bad", None)]


def test_local_frames(spark):
    typed = tables.typed_frame(spark, [(1, "x"), (None, None)], {"n": np.int32, "s": str})
    assert typed.dtypes == [("n", "int"), ("s", "string")]
    from pyspark.sql import Row

    inferred = tables.literal_rows(spark, [Row(a=1, b=2, c="string 1")])
    assert inferred.dtypes == [("a", "bigint"), ("b", "bigint"), ("c", "string")]


def test_domain_tables_round_trip_and_rerun(spark, tmp_path):
    schema = table_schema({"k": np.int64, "at": dt.datetime, "on": dt.date, "s": str})
    frame = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 2, 3), dt.date(2020, 1, 1), "x"), (None, None, None, None)], schema)
    for _ in range(2):
        results = writers.write_domains({"Visit": frame, "Person": frame.limit(0)}, str(tmp_path))
        assert [(r.name, r.rows, r.error) for r in results] == [("Visit", 2, None), ("Person", 0, None)]
    read = tables.read_tables(spark, str(tmp_path), ["Visit", "Never"], {"Visit": schema}, suffix="_parquet")
    assert list(read) == ["Visit"]
    assert sorted(map(str, read["Visit"].collect())) == sorted(map(str, frame.collect()))


def test_a_failing_table_does_not_stop_the_others(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("broken rule")).alias("x"))
    results = writers.write_each({"bad": bad, "good": spark.range(3)}, str(tmp_path))
    assert [r.name for r in results if r.error] == ["bad"]
    assert "broken rule" in results[0].error
    assert spark.read.parquet(str(tmp_path / "good.parquet")).count() == 3


def test_an_error_without_a_message_is_a_result(spark, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError

    monkeypatch.setattr(writers, "write_table", fail)
    assert [r.error for r in writers.write_each({"t": spark.range(1)}, str(tmp_path))] == ["RuntimeError: "]


def test_compaction(spark, tmp_path):
    schema = table_schema({"id": np.int64})
    base = str(tmp_path)
    spark.range(0, 100, 1, 20).write.parquet(f"{base}/visit")
    spark.range(5).write.parquet(f"{base}/stranger")
    results = writers.compact_tables(spark, base, {"visit": schema, "person": schema}, files=2)
    assert [(r.name, r.rows, r.error) for r in results] == [("visit", 100, None)]
    assert not (tmp_path / "visit").exists()
    assert (tmp_path / "stranger").exists()
    assert writers.count_output_files(spark, f"{base}/visit.parquet").first()[0] == 2
    assert spark.read.parquet(f"{base}/visit.parquet").count() == 100
    assert writers.compact_tables(spark, base, {"visit": schema, "person": schema}) == []
    assert spark.read.parquet(f"{base}/visit.parquet").count() == 100


def test_csv_sink_matches_pandas(spark, tmp_path):
    import pandas as pd

    rows = [("a,b", 1), ('say "hi"', None), ("", 3), (None, 4), ("back\\slash", 5)]
    frame = spark.createDataFrame(rows, "s string, n int")
    writers.write_csv(frame.coalesce(1), str(tmp_path / "out.csv"))
    text = next((tmp_path / "out.csv").glob("part-*.csv")).read_text()
    want = pd.DataFrame({"s": [r[0] for r in rows], "n": pd.array([r[1] for r in rows], dtype="Int32")}).to_csv(index=False)
    assert list(csv.reader(io.StringIO(text))) == list(csv.reader(io.StringIO(want)))


def test_csv_tables_report_their_rows(spark, tmp_path):
    results = writers.write_each({"t": spark.range(7), "none": spark.range(0)}, str(tmp_path), suffix=".csv", fmt="csv")
    assert [(r.name, r.rows, r.error) for r in results] == [("t", 7, None), ("none", 0, None)]


def test_csv_per_document(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a.xml", '<D><i a="1" b="x,y"/><i a="2"/></D>'), ("b.xml", "<D/>"), ("c.xml", '<D><i a="say &quot;3&quot;" b="l1&#10;l2"/></D>')],
        corpus.CORPUS_SCHEMA,
    )
    parsed = parse_documents(docs, [ITEMS])
    files = {r["file_name"]: r["csv"] for r in writers.document_csv(parsed, ITEMS).collect()}
    assert files == {
        "a.xml__items.csv": 'doc_id,a,b\r\na,1,"x,y"\r\na,2,\r\n',
        "c.xml__items.csv": 'doc_id,a,b\r\nc,"say ""3""","l1\nl2"\r\n',
    }
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3, "z")], "doc_id string, n int, s string")
    writers.write_csv_per_document(frame.coalesce(1), str(tmp_path / "items"))
    part = next((tmp_path / "items" / "doc_id=a").glob("*.csv"))
    assert part.read_bytes() == b"n,s\r\n1,x\r\n2,\r\n"


def test_partitioned_table(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "doc_id string, batch int")
    writers.write_table(frame, str(tmp_path / "t"), partition_by=["batch"])
    assert spark.read.parquet(str(tmp_path / "t")).where("batch = 2").select("doc_id").collect()[0][0] == "b"


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or work_dir(spark) == shared.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_listing_sees_all_and_opens_none(spark, tmp_path, monkeypatch):
    names = ["a.xml", "b c+d%20é.xml", "_h.xml", ".xml", "e;f.xml", "line\nbreak.xml"]
    for n in names:
        (tmp_path / n).write_text("" if n == "a.xml" else "x" * 7)
    (tmp_path / "UPPER.XML").write_text("x")
    (tmp_path / "dir.xml").mkdir()
    want = {(n, 0 if n == "a.xml" else 7, n[0] in "._") for n in names}
    assert {tuple(r) for r in corpus.list_documents(spark, str(tmp_path)).collect()} == want
    assert {tuple(r) for r in corpus.list_documents(spark, f"file://{tmp_path}").collect()} == want
    assert corpus.count_files(spark, str(tmp_path)).first()[0] == len(names)

    def unknown(path):
        raise ValueError("a file system that Arrow does not know")

    monkeypatch.setattr(corpus, "open_folder", unknown)
    assert {tuple(r) for r in corpus.list_documents(spark, str(tmp_path)).collect()} == want


def test_a_file_per_row(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = [(f"d{i}.xml__r.csv", f"a,é\r\n{i},\r\n") for i in range(300)] + [("empty.csv", ""), ("null.csv", None), ("b c+%20.csv", "x")]
    frame = spark.createDataFrame(rows, "file_name string, csv string").repartition(7)
    for _ in range(2):  # a rerun replaces the files
        files.write_files(frame, target, content="csv")
        found = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir() if not p.name.startswith("_")}
        assert found == {n: (t or "").encode() for n, t in rows}
        assert files.is_complete(target)
    files.write_files(frame.limit(0), f"file://{target}", content="csv")
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["_SUCCESS"]


def test_files_as_pandas_writes_them(spark, tmp_path):
    """A hundred documents, byte for byte."""
    import pandas as pd

    docs = [(f"d{i}.xml", f'<D><i a="{i}" b="x,&quot;y&quot;"/><i b=" {i}"/></D>') for i in range(100)]
    parsed = parse_documents(spark.createDataFrame(docs, corpus.CORPUS_SCHEMA), [ITEMS])
    files.write_files(writers.document_csv(parsed, ITEMS), str(tmp_path / "csv"), content="csv")
    for i in range(100):
        frame = pd.DataFrame([(f"d{i}", str(i), 'x,"y"'), (f"d{i}", None, f" {i}")], columns=["doc_id", "a", "b"])
        assert (tmp_path / "csv" / f"d{i}.xml__items.csv").read_bytes() == frame.to_csv(index=False, lineterminator="\r\n").encode()
    assert len(list((tmp_path / "csv").iterdir())) == 101


@pytest.mark.parametrize("name", ["", "a/b", "..", "_x", None])
def test_names_that_no_file_can_have(spark, tmp_path, name):
    frame = spark.createDataFrame([("good", "1"), (name, "2")], "file_name string, content string")
    with pytest.raises(Exception, match="no name for a file"):
        files.write_files(frame, str(tmp_path / "out"))
    assert not files.is_complete(str(tmp_path / "out"))
    assert list((tmp_path / "out").iterdir()) == []


def test_rows_that_share_a_name_are_refused(spark, tmp_path):
    frame = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "file_name string, content string").repartition(3)
    with pytest.raises(Exception, match="not unique"):
        files.write_files(frame, str(tmp_path / "out"))
    assert not files.is_complete(str(tmp_path / "out"))


def test_files_dealt_to_folders(spark, tmp_path, monkeypatch):
    """Millions of files: no listing holds all of their names, neither when they are written nor when they are read."""
    import pyarrow.fs as pafs

    target = str(tmp_path / "out")
    rows = [(f"d{i}.xml__r.csv", f"a,é\r\n{i},\r\n") for i in range(3000)] + [("empty.csv", ""), ("b c+%20.csv", "x"), ("0001", "y")]
    frame = spark.createDataFrame(rows, "file_name string, csv string").repartition(7)
    for _ in range(2):  # a rerun replaces the files
        files.write_files(frame, target, content="csv", folders=16)
        found = {p.name: p.read_bytes() for p in (tmp_path / "out").glob("*/*")}
        assert found == {n: t.encode() for n, t in rows}
        assert files.is_complete(target) and len(list((tmp_path / "out").iterdir())) == 17
    assert max(len(list(p.iterdir())) for p in (tmp_path / "out").iterdir() if p.is_dir()) < 400

    read = corpus.scan_files(spark, target)
    assert sorted((r["file_name"], bytes(r["content"]).decode()) for r in read.collect()) == sorted(rows)

    # The writer's end, which runs beside the driver, lists one folder at a time; so does its begin.
    sizes = []
    listed = pafs.LocalFileSystem.get_file_info

    class Counted:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def get_file_info(self, what):
            got = listed(self.fs, what)
            sizes.append(len(got) if isinstance(got, list) else 1)
            return got

    opened = files.open_folder
    monkeypatch.setattr(files, "open_folder", lambda p: (Counted(opened(p)[0]), opened(p)[1]))
    writer = files.FileWriter(str(tmp_path / "direct"), overwrite=True, folders=16)
    import pyarrow as pa

    batch = pa.record_batch([pa.array([n for n, _ in rows]), pa.array([t.encode() for _, t in rows])], names=["file_name", "content"])
    writer.commit([writer.write(iter([batch])), None])
    files.FileWriter(str(tmp_path / "direct"), overwrite=True, folders=16).abort([])
    assert max(sizes) < 400 and list((tmp_path / "direct").iterdir()) == []


def test_files_in_one_folder_are_read_too(spark, tmp_path):
    rows = [(f"d{i}.csv", f"{i}") for i in range(50)] + [("null.csv", None), ("é +%41;.csv", "x")]
    files.write_files(spark.createDataFrame(rows, "file_name string, content string").repartition(3), str(tmp_path / "out"))
    (tmp_path / "out" / "_hidden").write_text("x")
    read = corpus.scan_files(spark, f"file://{tmp_path}/out")
    assert sorted((r["file_name"], bytes(r["content"]).decode()) for r in read.collect()) == sorted((n, t or "") for n, t in rows)
    (tmp_path / "out" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="not complete"):
        corpus.scan_files(spark, str(tmp_path / "out"))


def test_rows_that_share_a_name_are_refused_in_folders_too(spark, tmp_path):
    frame = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "file_name string, content string").repartition(3)
    with pytest.raises(Exception, match="not unique"):
        files.write_files(frame, str(tmp_path / "out"), folders=4)
    assert not files.is_complete(str(tmp_path / "out")) and list((tmp_path / "out").iterdir()) == []


def test_csv_files_lists_no_folder_in_the_driver(spark, sf):
    from docmart.plans.queries import QUERIES

    plan = QUERIES["csv_files"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "FileScan" not in plan
