from __future__ import annotations

import random

from pyspark.sql import functions as F

from docmart.operators import report
from docmart.operators.extract import with_counts
from docmart.operators.parse import parse_documents
from docmart.plans.config import DomainConfig, Routing, Step, document_id, from_path

LINES = ["OK: a -> t", "ERROR: f.xml :: boom", "ERROR: g :: h.xml :: boom", "noise", "  ERROR consolidating x", "ERROR: odd"]


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_status_counts(spark):
    assert [tuple(r) for r in report.status_counts(lines(spark, LINES)).collect()] == [("OK", 1), ("ERROR", 3)]
    assert [tuple(r) for r in report.status_counts(lines(spark, ["noise"])).collect()] == [("OK", 0), ("ERROR", 0)]


def test_error_histogram(spark):
    got = [tuple(r) for r in report.error_histogram(lines(spark, LINES)).collect()]
    assert got == [("boom", 2), ("ERROR: odd", 1)]


CONFIGS = [
    DomainConfig("r", (document_id(), from_path("v", "_v")), (Step("r"),)),
    DomainConfig("s", (document_id(), from_path("v", "_v"), from_path("w", "_w")), (Step("s"),)),
    DomainConfig("lost", (document_id(),), (Step("n"),)),
]
ROUTING = Routing({"r": "R", "s": "S"}, {"R": "r_table", "S": "s_table"}, {"r_table": {"v": str}, "s_table": {"v": str}})


def counted(spark, documents):
    docs = spark.createDataFrame(documents, "file_name string, xml string")
    return with_counts(parse_documents(docs, CONFIGS), CONFIGS)


def test_run_status_is_per_whole_document(spark):
    frame = counted(spark, [("a.xml", '<D><r v="1"/><r v="2"/><s v="3"/></D>'), ("b.xml", "<D><n/></D>"), ("c.xml", "<D><r v='1'/>")])
    status = report.run_status(frame, CONFIGS, ROUTING)
    got = sorted(r["line"] for r in status.select(report.status_line().alias("line")).collect())
    assert got == ["ERROR: c.xml :: malformed XML: cut off", "OK: a -> r_table", "OK: a -> s_table"]
    assert sorted(map(tuple, report.ok_pairs(status).collect())) == [
        ("a", "r_table"), ("a", "s_table"), ("c", "quarantine: malformed XML: cut off"),
    ]


def test_counts(spark):
    frame = counted(spark, [("a.xml", '<D><r v="1"/><r v="2"/></D>'), ("b.xml", "<D><r/><n/></D>"), ("c.xml", "x")])
    assert {tuple(r) for r in report.config_counts(frame, CONFIGS).collect()} == {("r", 3), ("s", 0), ("lost", 1)}
    assert {tuple(r) for r in report.table_counts(frame, CONFIGS, ROUTING).collect()} == {("r_table", 3)}
    pairs = report.table_counts_per_document(frame, CONFIGS, ROUTING)
    assert {tuple(r) for r in pairs.collect()} == {("a", "r_table", 2), ("b", "r_table", 1)}


def test_counts_of_an_empty_corpus(spark):
    frame = counted(spark, [])
    assert report.table_counts(frame, CONFIGS, ROUTING).collect() == []
    assert {tuple(r) for r in report.config_counts(frame, CONFIGS).collect()} == {("r", 0), ("s", 0), ("lost", 0)}


def test_running_total_against_brute_force(spark):
    rng = random.Random(7)
    # One group holds most rows, and many of its values are null.
    data = [(rng.choice("aaaaab"), f"doc{i}", rng.choice([None, 1, 2, 50])) for i in range(3000)]
    frame = spark.createDataFrame(data, "g string, k string, v bigint")
    got = {(r["g"], r["k"]): (r["running"], r["position"]) for r in report.running_total(frame, "g", "k", "v").collect()}
    import hashlib

    want = {}
    for group in "ab":
        total = 0
        mine = sorted((hashlib.md5(k.encode()).hexdigest(), k, v) for g, k, v in data if g == group)
        for i, (_, k, v) in enumerate(mine, start=1):
            total += v or 0
            want[group, k] = (total, i)
    assert got == want


def test_running_total_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    out = report.running_total(frame.repartition(3).mapInArrow(count, frame.schema), "g", "k", "v")
    assert out.count() == 1000
    assert seen.value == 1000


def test_one_hot_group_spreads_over_the_ranges(spark):
    frame = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    largest = []
    for tasks in (4, 16):
        plan = report.running_total(frame, "g", "k", "v", tasks)
        assert plan.agg(F.max("running")).first()[0] == 19_999 * 10_000
        path = plan.inputFiles()[0].rsplit("/", 1)[0]
        sizes = spark.read.parquet(path).groupBy("__range").count()
        largest.append(sizes.agg(F.max("count")).first()[0])
    assert largest[0] < 2 * 20_000 / 4 and largest[1] < 2 * 20_000 / 16


def test_shape_log(spark):
    frame = counted(spark, [("a.xml", '<D><r v="1"/><r v="2"/></D>'), ("b.xml", "<D><r/><s/></D>"), ("c.xml", "x")])
    rows = {(r["doc_id"], r["config"]): r for r in report.shape_log(frame, CONFIGS).collect()}
    assert len(rows) == 6
    assert (rows["a", "r"]["n_rows"], rows["a", "r"]["n_columns"]) == (2, 2)
    assert rows["a", "s"]["n_rows"] is rows["a", "s"]["n_columns"] is rows["a", "s"]["running_rows"] is None
    # By md5, 'b' (92eb...) comes after 'a' (0cc1...).
    assert [rows["a", "r"]["running_rows"], rows["b", "r"]["running_rows"]] == [2, 3]
    assert [rows["a", c]["configs_seen"] for c in ("r", "s", "lost")] == [1, 2, 3]
    assert [rows["b", c]["configs_seen"] for c in ("r", "s", "lost")] == [3, 3, 3]


def test_preview_and_probe(spark):
    frame = spark.createDataFrame([(3, None), (1, "b"), (2, "a")], "k int, v string")
    assert [r["k"] for r in report.preview(frame, ["k"], 2).collect()] == [1, 2]
    assert tuple(report.column_probe(frame, "v", ["k"]).first()) == ("v", "b", "string")
    assert tuple(report.column_probe(frame.where("k = 3"), "v", ["k"]).first()) == ("v", None, "string")
