"""Parsing, extraction, lookup, alignment and routing on small documents."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmart.operators.align import align_to_types, combine_domains, union_all
from docmart.operators.extract import extract, with_counts
from docmart.operators.lookup import apply_lookups, code_misses, lookup, unique_codemap
from docmart.operators.parse import element_tree, parse_documents, parse_schema, quarantine
from docmart.operators.route import filter_domains, route, routes_frame, unrouted
from docmart.plans.config import (
    DomainConfig,
    Routing,
    Step,
    code_lookup,
    constant,
    document_id,
    from_document,
    from_path,
    from_step,
    position,
    select_configs,
)
from docmart.plans.pipeline import convert_table

# A nested document: sections, entries, repeated ids, a prefixed attribute.
CHART = """<?xml version="1.0" encoding="UTF-8"?>
<!-- a chart -->
<ClinicalDocument xmlns="urn:hl7-org:v3" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
  <id root="r" extension="d1"/>
  <patient><id extension="p1"/><id extension="p1-other"/></patient>
  <component><structuredBody>
    <component><section><code code="VITAL"/><title>Vital signs</title>
      <entry><organizer><effectiveTime value="20240102"/>
        <component><observation><code code="8480-6" codeSystem="LN"/><value xsi:type="PQ" value="120" unit="mm"/></observation></component>
        <component><observation><code code="8462-4" codeSystem="LN"/><value xsi:type="PQ" value=" 80.9 " unit="mm"/></observation></component>
      </organizer></entry>
      <entry><organizer><effectiveTime value="20240103"/>
        <component><observation><code code="999" codeSystem="LN"/><value xsi:type="ST">tall &amp; thin</value></observation></component>
      </organizer></entry>
    </section></component>
    <component><section><code code="RESULT"/><title>Results</title>
      <entry><organizer><effectiveTime value="20240104"/>
        <component><observation><code code="8480-6" codeSystem="LN"/><value value="1"/></observation></component>
      </organizer></entry>
    </section></component>
  </structuredBody></component>
</ClinicalDocument>"""

SECTION = Step("component.structuredBody.component", where={"section.code._code": "VITAL"})
HOPS = (SECTION, Step("section.entry"), Step("organizer.component"))
VITALS = DomainConfig(
    "vitals",
    (
        document_id(),
        from_document("person", "patient.id._extension"),
        from_step("section", 0, "section.title"),
        from_step("taken", 1, "organizer.effectiveTime._value"),
        from_path("code", "observation.code._code"),
        from_path("value", "observation.value._value"),
        from_path("text", "observation.value"),
        from_path("kind", "observation.value._xsi:type"),
        position("place"),
        constant("source", "chart"),
        code_lookup("concept_id", "observation.code._codeSystem", "observation.code._code"),
    ),
    HOPS,
)
# Declares the id as repeated, so that the other config's path takes the first.
IDS = DomainConfig("ids", (document_id("doc"), from_path("id", "_extension")), (Step("patient.id"),))


def corpus(spark, documents):
    return spark.createDataFrame(documents, "file_name string, xml string")


def codemap(spark):
    return spark.createDataFrame([("LN", "8480-6", 1), ("LN", "8462-4", 2)], "code_system string, code string, concept_id bigint")


def test_nested_extraction(spark):
    parsed = parse_documents(corpus(spark, [("a.xml", CHART)]), [VITALS, IDS])
    records = apply_lookups(extract(parsed, [VITALS], [VITALS, IDS]), [VITALS], codemap(spark))
    rows = records.select("doc_id", "person", "section", "taken", "code", "value", "text", "kind", "place", "source", "concept_id")
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("a", "p1", "Vital signs", "20240102", "8462-4", " 80.9 ", None, "PQ", "1", "chart", 2),
        ("a", "p1", "Vital signs", "20240102", "8480-6", "120", None, "PQ", "0", "chart", 1),
        ("a", "p1", "Vital signs", "20240103", "999", None, "tall & thin", "ST", "0", "chart", 0),
    ]
    ids = extract(parsed, [IDS], [VITALS, IDS]).select("doc", "id")
    assert sorted(tuple(r) for r in ids.collect()) == [("a", "p1"), ("a", "p1-other")]


def test_several_configs_share_one_pass(spark):
    parsed = parse_documents(corpus(spark, [("a.xml", CHART)]), [VITALS, IDS])
    both = extract(parsed, [VITALS, IDS])
    counts = {r["config"]: r["count"] for r in both.groupBy("config").count().collect()}
    assert counts == {"vitals": 3, "ids": 2}
    assert both._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    ids = both.where("config = 'ids'").select("code", "id").collect()
    assert all(r["code"] is None for r in ids)


def test_parse_schema_is_minimal_and_all_text():
    schema = parse_schema([IDS])
    assert schema.simpleString() == "struct<patient:array<struct<id:array<struct<_extension:string>>>>,_corrupt_record:string>"
    assert element_tree([VITALS]).children.keys() == {"component", "patient"}


def test_repeated_elements_on_a_path(spark):
    section = Step("section", where={"template[]._root": "T2", "code._code": "X"})
    config = DomainConfig("c", (document_id(), from_step("id", 0, "id[]._ext"), from_path("v", "_v")), (section, Step("row")))
    text = """<D>
      <section><template root="T1"/><template root="T2"/><code code="X"/><id ext="a"/><id ext="b"/><row v="1"/><row v="2"/></section>
      <section><template root="T1"/><code code="X"/><row v="3"/></section>
      <section><template root="T2"/><code code="Y"/><row v="4"/></section>
      <section><template root="T2"/><row v="5"/></section>
      <section><template root="T2"/><code code="X"/><row v="6"/></section>
    </D>"""
    got = extract(parse_documents(corpus(spark, [("d.xml", text)]), [config]), [config])
    assert sorted(tuple(r) for r in got.select("v", F.coalesce("id", F.lit("-"))).collect()) == [("1", "a"), ("2", "a"), ("6", "-")]


FAULTY = [
    ("good.xml", CHART),
    ("cut.xml", CHART[:200]),
    ("empty.xml", ""),
    ("blank.xml", " \n\t "),
    ("none.xml", None),
    ("plain.xml", "no markup"),
    ("entity.xml", '<!DOCTYPE d [<!ENTITY e "x">]><ClinicalDocument><a v="&e;"/></ClinicalDocument>'),
    ("other.xml", "<ClinicalDocument><unknown/></ClinicalDocument>"),
]


def test_faulty_documents_are_set_aside(spark):
    parsed = parse_documents(corpus(spark, FAULTY), [VITALS])
    bad = {r["file_name"]: (r["doc_id"], r["message"], r["xml"]) for r in quarantine(parsed).collect()}
    assert bad == {
        "cut.xml": ("cut", "malformed XML: cut off", CHART[:200]),
        "empty.xml": ("empty", "empty document", ""),
        "blank.xml": ("blank", "empty document", " \n\t "),
        "none.xml": ("none", "unreadable document", None),
        "plain.xml": ("plain", "malformed XML: not XML", "no markup"),
        "entity.xml": ("entity", "malformed XML: bad entity", FAULTY[6][1]),
    }
    assert {r["doc_id"] for r in extract(parsed, [VITALS]).collect()} == {"good"}
    counts = {r["doc_id"]: r["counts"]["vitals"] for r in with_counts(parsed, [VITALS]).collect()}
    assert counts == {"good": 3} | {n.removesuffix(".xml"): None for n, _ in FAULTY[1:]}


def test_nothing_behind_the_root_is_lost_in_silence(spark):
    texts = {
        "<D/>": None,
        "<D></D><!-- c --> \n<?p?>": None,
        "<D></D>x": "content after the root",
        "<D></D><D></D>": "content after the root",
        "<D/><E/>": "content after the root",
        "<D/><D></D>": "content after the root",
        "<D></D ><D></D>": "content after the root",
        "<D a='1' /><D></D>": "content after the root",
        "<D></D>  ": None,
        "<D></D >": None,
        "<D><Dx></Dx></D>": None,
        "<D><b></D>": "malformed XML: mismatched tag or bad character",
        "<D>": "malformed XML: cut off",
    }
    docs = corpus(spark, [(f"{i}.xml", t) for i, t in enumerate(texts)])
    found = {int(r["doc_id"]): r["error"] for r in parse_documents(docs, [DomainConfig("c", (document_id(),))]).collect()}
    assert [found[i] for i in range(len(texts))] == list(texts.values())


def test_of_two_elements_where_one_is_declared_the_first_counts(spark):
    config = DomainConfig("c", (from_path("a", "p.x._v"), from_path("b", "t")), (Step("s", many=False),))
    docs = corpus(spark, [("d.xml", '<D><s><p><x v="1"/><x v="2"/></p><p><x v="3"/></p><t>4</t><t>5</t></s><s><t>6</t></s></D>')])
    assert [tuple(r) for r in extract(parse_documents(docs, [config]), [config]).select("a", "b").collect()] == [("1", "4")]


def test_document_level_and_single_child_records(spark):
    one = DomainConfig("one", (document_id(), from_path("id", "id._extension")))
    many = DomainConfig("many", (document_id(), from_path("v", "_v")), (Step("r"),))
    single = DomainConfig("single", (document_id(), from_path("v", "_v")), (Step("s", many=False),))
    docs = corpus(spark, [("a.xml", '<D><id extension="1"/><r v="x"/><s v="y"/></D>'), ("b.xml", "<D/>")])
    parsed = parse_documents(docs, [one, many, single])

    def rows(config, column):
        return sorted(((r["doc_id"], r[column]) for r in extract(parsed, [config], [one, many, single]).collect()), key=str)

    assert rows(one, "id") == [("a", "1"), ("b", None)]
    assert rows(many, "v") == [("a", "x")]
    assert rows(single, "v") == [("a", "y")]


def test_lookup_keeps_every_row(spark):
    rows = [("LN", "8480-6"), ("LN", "zzz"), ("XX", "8480-6"), (None, "8480-6"), ("LN", None), ("LN", "8480-6")]
    frame = spark.createDataFrame(rows, "s string, c string")
    got = lookup(frame, codemap(spark), "s", "c", "concept").collect()
    assert sorted((r["s"] or "", r["c"] or "", r["concept"]) for r in got if r["concept"]) == [("LN", "8480-6", 1)] * 2
    assert len(got) == len(rows)


def test_duplicate_codes_do_not_multiply_rows(spark):
    twice = codemap(spark).union(codemap(spark)).union(spark.createDataFrame([("LN", "8480-6", 9)], codemap(spark).schema))
    unique = unique_codemap(twice)
    assert {(r["code"], r["concept_id"]) for r in unique.collect()} == {("8480-6", 9), ("8462-4", 2)}
    frame = spark.createDataFrame([("LN", "8480-6")], "s string, c string")
    assert lookup(frame, unique, "s", "c", "concept").count() == 1


def test_lookup_result_is_the_same_by_shuffle(spark):
    frame = spark.range(2000).select(F.lit("LN").alias("s"), F.when(F.col("id") % 3 == 0, "8480-6").otherwise(F.col("id").cast("string")).alias("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(frame, codemap(spark), "s", "c", "concept")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert (joined.count(), joined.where("concept = 1").count()) == (2000, 667)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_codes_are_split_when_the_codemap_is_too_large_to_broadcast(spark):
    """Nine rows of ten carry one code; AQE splits its partition instead of leaving it to one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        code = F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("8480-6")
        system = F.when(F.col("id") % 1000 == 1, "XX").otherwise("LN")
        frame = spark.range(0, 300_000, 1, 6).select(system.alias("s"), code.alias("c"), F.md5(F.col("id").cast("string")).alias("pad"))
        of_map = F.when(F.col("id") % 1000 == 1, "YY").otherwise("LN")
        big = spark.range(50_000).select(of_map.alias("code_system"), F.col("id").cast("string").alias("code"), F.col("id").alias("concept_id"))
        joined = lookup(frame, unique_codemap(big.union(codemap(spark))), "s", "c", "concept")
        rows = joined.collect()
        assert len(rows) == 300_000
        assert sum(1 for r in rows if r["concept"] == 1 and r["c"] == "8480-6") == 269_700
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_code_misses(spark):
    codes = spark.createDataFrame([("LN", "8480-6"), ("LN", "x"), ("LN", "x"), ("LN", None)], "code_system string, code string")
    assert [tuple(r) for r in code_misses(codes, codemap(spark)).collect()] == [("LN", "x", 2)]


def test_no_default_leaves_null(spark):
    config = DomainConfig("c", (document_id(), code_lookup("concept_id", "_s", "_c", default=None)), (Step("r"),))
    docs = corpus(spark, [("a.xml", '<D><r s="LN" c="8480-6"/><r s="LN" c="no"/><r/></D>')])
    got = apply_lookups(extract(parse_documents(docs, [config]), [config]), [config], codemap(spark))
    assert sorted(str(r["concept_id"]) for r in got.collect()) == ["1", "None", "None"]


def test_lookup_with_a_fixed_system(spark):
    config = DomainConfig("c", (document_id(), code_lookup("concept_id", "", "_c", system="LN")), (Step("r"),))
    both = DomainConfig("b", (document_id(), code_lookup("concept_id", "_s", "_c", system="LN")), (Step("r"),))
    docs = corpus(spark, [("a.xml", '<D><r s="XX" c="8480-6"/><r c="8462-4"/></D>')])
    for chosen, want in ((config, [1, 2]), (both, [0, 2])):
        got = apply_lookups(extract(parse_documents(docs, [chosen]), [chosen]), [chosen], codemap(spark))
        assert sorted(r["concept_id"] for r in got.collect()) == want


def test_one_column_looked_up_and_read(spark):
    looked_up = DomainConfig("a", (document_id(), code_lookup("concept_id", "", "_c", system="LN")), (Step("r"),))
    read = DomainConfig("b", (document_id(), from_path("concept_id", "_id")), (Step("q"),))
    docs = corpus(spark, [("a.xml", '<D><r c="8480-6"/><r c="no"/><q id="7"/><q id="bad"/></D>')])
    pair = [looked_up, read]
    got = apply_lookups(extract(parse_documents(docs, pair), pair), pair, codemap(spark))
    assert sorted((r["config"], str(r["concept_id"])) for r in got.collect()) == [("a", "0"), ("a", "1"), ("b", "7"), ("b", "None")]


def test_align(spark):
    frame = spark.createDataFrame([("1.9", "x", "drop")], "n string, s string, extra string")
    out = align_to_types(frame, {"s": str, "missing": dt.datetime, "n": np.int64, "odd": list})
    assert out.dtypes == [("s", "string"), ("missing", "timestamp"), ("n", "bigint"), ("odd", "string")]
    assert [tuple(r) for r in out.collect()] == [("x", None, 1, None)]


def test_union_all(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(1, "y"), (1, "y")], "k int, b string")
    assert union_all([None, None]) is None
    out = union_all([None, a, None, b])
    assert out.columns == ["k", "a", "b"]
    assert sorted(map(str, out.collect())) == sorted(["Row(k=1, a='x', b=None)", *["Row(k=1, a=None, b='y')"] * 2])


ROUTING = Routing(
    {"c1": "Measurement", "c2": "Measurement", "c3": "Visit", "c4": "Lost"},
    {"Measurement": "measurement", "Visit": "visit"},
    {"measurement": {"v": np.int64}, "visit": {"v": str}},
)


def test_combine_domains_casts_before_the_union(spark):
    frames = {
        "c1": spark.createDataFrame([("7",), ("bad",)], "v string"),
        "c2": spark.createDataFrame([(8,)], "v int"),
        "c3": None,
        "c4": spark.createDataFrame([("lost",)], "v string"),
    }
    out = combine_domains(frames, ROUTING)
    assert list(out) == ["Measurement"]
    assert sorted(str(r["v"]) for r in out["Measurement"].collect()) == ["7", "8", "None"]


def test_routing(spark):
    configs = [DomainConfig(n, (document_id(),)) for n in ("c1", "c2", "c3", "c4", "c5")]
    routes = routes_frame(spark, configs, ROUTING)
    rows = spark.createDataFrame([("c1",), ("c3",), ("c4",), ("c5",)], "config string")
    assert sorted(r["table"] for r in route(rows, routes).collect()) == ["measurement", "visit"]
    assert sorted(r["config"] for r in unrouted(rows, routes).collect()) == ["c4", "c5"]
    routed = route(rows, routes)
    assert [r["domain"] for r in filter_domains(routed, exclude=["Visit", "Observation"]).collect()] == ["Measurement"]
    assert [r["domain"] for r in filter_domains(routed, include=["Visit"]).collect()] == ["Visit"]
    assert ROUTING.select_domains(exclude=["Visit"]).tables(configs).keys() == {"measurement"}


def test_config_selection_and_validation():
    configs = [DomainConfig("a", (document_id(),)), DomainConfig("b", (document_id(),))]
    assert select_configs(configs, "") == select_configs(configs, None) == configs
    assert [c.name for c in select_configs(configs, ["b"])] == ["b"]
    with pytest.raises(ValueError, match="unknown"):
        select_configs(configs, "z")
    with pytest.raises(ValueError, match="twice"):
        DomainConfig("a", (document_id(), document_id()))
    with pytest.raises(ValueError, match="hop"):
        DomainConfig("a", (from_step("x", 1, "p"),), (Step("r"),))


def test_partitioning_does_not_change_a_table(spark):
    routing = Routing({"vitals": "M"}, {"M": "m"}, {"m": {"doc_id": str, "value": np.float64, "concept_id": np.int64}})
    docs = corpus(spark, [(f"{i}.xml", CHART) for i in range(20)] + FAULTY[1:])
    results = []
    for parts in (1, 17):
        table = convert_table(docs.repartition(parts), "m", [VITALS], routing, codemap(spark))
        results.append(sorted(map(str, table.collect())))
    assert results[0] == results[1]
    assert len(results[0]) == 60
