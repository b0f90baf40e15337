"""The whole job on folders, and the plans it runs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from docmart import convert, convert_directory, convert_table
from docmart.operators import report
from docmart.operators.extract import with_counts
from docmart.operators.parse import parse_documents
from docmart.plans import clinical as C
from docmart.session import path_exists, work_dir
from docmart.sources import writers


@pytest.fixture(scope="module")
def job(spark, sf):
    return convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf))


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_stage_and_single_pass_agree(spark, sf, job):
    for table in job.table_names():
        direct = convert_table(C.documents(spark, sf), table, C.CONFIGS, C.ROUTING, C.codemap(spark, sf))
        assert direct.schema == job.table(table).schema == C.ROUTING.schema(table)
        assert rows(direct) == rows(job.table(table))


def test_the_two_forms_of_the_corpus_agree(spark, sf):
    """Documents as concatenated text, and as columns through ``to_xml``, parse to the same."""
    columns = [c.alias(n) for n, c in C._document_columns().items()]
    written = F.to_xml(F.struct(*columns), {"rowTag": C.ROOT})
    intact = C._orders(spark, sf).where("o_orderkey % 97 >= 8 and o_orderkey % 13 > 0").select(F.concat("o_orderkey", F.lit(".xml")).alias("file_name"), written.alias("xml"))
    direct = C.documents(spark, sf).join(intact.select("file_name"), "file_name", "left_semi")
    a, b = (rows(parse_documents(frame, C.CONFIGS)) for frame in (intact, direct))
    assert len(a) > 1000
    assert a == b


def test_every_row_is_accounted_for(spark, job):
    counts = {r["table"]: r["n"] for r in job.table_counts().collect()}
    assert counts == {t: n for t in job.table_names() if (n := job.table(t).count())}
    assert "device" not in counts
    assert [r["config"] for r in job.unmapped().collect()] == ["notes"]
    assert job.unmapped().first()["n"] > 0
    unread = job.quarantine().count()
    assert unread + job.table("person").count() == job.parsed.count()
    assert job.status().where("status = 'ERROR'").count() == unread


def test_excluded_domains_stay_out_and_are_reported(spark, sf):
    job = convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf), exclude_domains=["Visit"])
    assert "visit" not in job.table_names()
    assert {r["config"] for r in job.unmapped().collect()} == {"encounter", "notes"}


def test_write_is_idempotent_and_skips_empty_tables(spark, job, tmp_path):
    for _ in range(2):
        results = job.write(str(tmp_path))
        assert sorted(r.name for r in results) == ["drug", "measurement", "person", "visit"]
        assert not any(r.error for r in results)
        assert all(r.rows == job.table(r.name).count() for r in results)
    assert rows(spark.read.parquet(str(tmp_path / "visit.parquet"))) == rows(job.table("visit"))
    assert writers.count_output_files(spark, str(tmp_path)).first()[0] >= 4


def test_directory_job(spark, sf, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    documents = C.documents(spark, sf).limit(200).collect()
    for r in documents:
        (source / r["file_name"]).write_text(r["xml"], encoding="utf-8")
    writers.write_csv(C.codemap(spark, sf), str(tmp_path / "map.csv"))
    kept = set(os.listdir(work_dir(spark)))
    written, status = convert_directory(spark, str(source), str(tmp_path / "map.csv"), str(target), C.CONFIGS, C.ROUTING)
    assert not any(r.error for r in written)
    corpus = spark.createDataFrame(documents, "file_name string, xml string")
    assert [r.name for r in written[-3:]] == ["run_status", "quarantine", "unmapped"]
    assert set(os.listdir(work_dir(spark))) <= kept
    for r in written[:-3]:
        expected = convert_table(corpus, r.name, C.CONFIGS, C.ROUTING, C.codemap(spark, sf))
        assert rows(spark.read.schema(expected.schema).parquet(r.path)) == rows(expected)
    assert status.where("line LIKE 'OK: %'").count() > 0
    assert {"run_status.parquet", "quarantine.parquet", "unmapped.parquet"} <= set(os.listdir(target / "_run"))
    with pytest.raises(ValueError, match="xml"):
        convert_directory(spark, str(target), str(tmp_path / "map.csv"), str(target), C.CONFIGS, C.ROUTING)


def test_a_failed_write_is_no_ok_and_keeps_the_stage(spark, sf, tmp_path, monkeypatch):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for r in C.documents(spark, sf).limit(120).collect():
        (source / r["file_name"]).write_text(r["xml"], encoding="utf-8")
    writers.write_csv(C.codemap(spark, sf), str(tmp_path / "map.csv"))
    real = writers.write_table

    def write(df, path, *args, **kwargs):
        if path.endswith(("/drug.parquet", "/quarantine.parquet")):
            raise OSError("disk gone")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(writers, "write_table", write)
    before = set(os.listdir(work_dir(spark)))
    written, status = convert_directory(spark, str(source), str(tmp_path / "map.csv"), str(target), C.CONFIGS, C.ROUTING)
    assert sorted(r.name for r in written if r.error) == ["drug", "quarantine"]
    assert status.where("line LIKE 'OK: % -> drug'").count() == 0
    assert status.where("line LIKE 'ERROR: %table drug not written: OSError: disk gone'").count() > 0
    assert status.where("line LIKE 'OK: % -> person'").count() > 0
    assert any("parsed-" in d for d in set(os.listdir(work_dir(spark))) - before)


def test_a_table_without_rows_is_removed(spark, sf, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "device.parquet"))
    convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf)).write(str(tmp_path))
    assert not (tmp_path / "device.parquet").exists() and (tmp_path / "person.parquet").exists()


def test_command_line(spark, sf, tmp_path, capsys):
    from docmart.__main__ import main

    source = tmp_path / "in"
    source.mkdir()
    for r in C.documents(spark, sf).limit(30).collect():
        (source / r["file_name"]).write_text(r["xml"], encoding="utf-8")
    writers.write_csv(C.codemap(spark, sf), str(tmp_path / "map.csv"))
    args = ["--input", str(source), "--output", str(tmp_path / "out"), "--codemap", str(tmp_path / "map.csv")]
    assert main([*args, "--declarations", "docmart.plans.clinical", "--only", "patient", "encounter"]) == 0
    out = capsys.readouterr().out
    assert "person: " in out and "visit: " in out and "measurement" not in out


def test_command_line_on_files_of_many_documents(spark, sf, tmp_path, capsys):
    from docmart.__main__ import main

    C.write_batches(spark, sf, str(tmp_path / "in"))
    writers.write_csv(C.codemap(spark, sf), str(tmp_path / "map.csv"))
    args = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--codemap", str(tmp_path / "map.csv")]
    args += ["--declarations", "docmart.plans.clinical"]
    assert main([*args, "--row-tag", C.ROOT, "--id-path", "id._extension"]) == 0
    assert "measurement: " in capsys.readouterr().out
    expected = convert_table(C.documents(spark, sf), "measurement", C.CONFIGS, C.ROUTING, C.codemap(spark, sf))
    # Between documents nothing counts, so what has more after its root is a document here.
    found = spark.read.parquet(str(tmp_path / "out" / "measurement.parquet"))
    assert rows(found.where("doc_id % 97 <> 2")) == rows(expected)
    with pytest.raises(SystemExit):
        main([*args, "--row-tag", C.ROOT])


def test_a_job_without_any_table(spark, sf, tmp_path):
    job = convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf), only="notes")
    assert job.table_names() == []
    assert job.table_counts().collect() == []
    assert job.write(str(tmp_path)) == []
    assert job.status().where("status = 'OK'").count() == 0
    assert job.status().where("status = 'ERROR'").count() == job.quarantine().count() > 0
    assert report.table_counts_per_document(job.parsed, job.configs, job.routing).count() == 0
    assert [r["config"] for r in job.unmapped().collect()] == ["notes"]
    with pytest.raises(ValueError, match="no configs"):
        convert(C.documents(spark, sf), [], C.ROUTING, C.codemap(spark, sf))


def test_csv_per_document(spark, sf, tmp_path):
    corpus = C.documents(spark, sf).where("file_name IN ('13.xml', '14.xml', '15.xml')")
    job = convert(corpus, [C.RESULTS, C.NOTES], C.ROUTING, C.codemap(spark, sf))
    job.write_csv_per_document(str(tmp_path))
    for config in ("results", "notes"):
        records = job.records(config)
        for row in records.groupBy("doc_id").count().collect():
            files = list((tmp_path / config / f"doc_id={row['doc_id']}").glob("*.csv"))
            text = b"".join(f.read_bytes() for f in files).decode()
            lines = text.split("\r\n")
            assert lines[0] == ",".join(c for c in records.columns if c != "doc_id")
            assert len(lines) == row["count"] + 2


def test_dropped_stage(spark, sf):
    job = convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf), only="patient")
    assert job.table_names() == ["person"]
    job.drop_stage()
    assert not path_exists(spark, job.stage)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_single_pass_parses_once_and_does_not_shuffle_records(spark, sf):
    table = convert_table(C.documents(spark, sf), "measurement", C.CONFIGS, C.ROUTING, C.codemap(spark, sf))
    text = plan(table)
    assert text.count("from_xml(") == 1
    assert "BroadcastHashJoin" in text
    # The orders' spread and the codemap's grouping; no exchange above the parse.
    assert text.count("Exchange hashpartitioning") == 2
    above_parse = text[: text.index("from_xml(")]
    assert "Exchange hashpartitioning" not in above_parse


def test_the_stage_parses_once(spark, sf):
    staged = with_counts(parse_documents(C.documents(spark, sf), C.CONFIGS), C.CONFIGS)
    assert plan(staged).count("from_xml(") == 1


def test_staged_tables_read_only_their_elements(spark, job):
    scan = plan(job.table("person"))
    schema = scan[scan.index("ReadSchema") :].splitlines()[0]
    assert "results" not in schema and "vitals" not in schema
    for report in (job.table_counts(), job.shape_log(), job.status()):
        text = plan(report)
        assert all("doc:" not in line for line in text.split("ReadSchema")[1:])
