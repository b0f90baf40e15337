"""Joins that split heavy keys off, and joins that keep rows without a match out of the shuffle."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docmart.operators.sift import sift, sifted_join
from docmart.operators.skew import heavy_keys, split_join


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(1)
    left = [(rng.choice([7, 7, 7, None, rng.randrange(300)]), rng.choice(["a", None]), i) for i in range(3000)]
    right = [(k, s, 10 * k) for k in range(200) for s in ("a", "b")]
    return spark.createDataFrame(left, "k long, s string, i long").repartition(4), spark.createDataFrame(right, "k long, s string, v long"), left


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [2, 10, 100_000])
def test_split_join(frames, how, share):
    left, right, rows = frames
    got = split_join(left, right, ["k", "s"], heavy_keys(left, ["k", "s"], share), how)
    want = left.join(right, ["k", "s"], how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_heavy_keys_are_few(frames):
    left, _, rows = frames
    counts = Counter((k, s) for k, s, _ in rows)
    for share in (3, 20, 1000):
        got = {(r["k"], r["s"]) for r in heavy_keys(left, ["k", "s"], share).collect()}
        assert got == {k for k, n in counts.items() if n * share > len(rows)}
        assert len(got) < share


@pytest.mark.parametrize("words", [1, 8, 1 << 19])
def test_sifted_join(frames, words):
    left, right, _ = frames
    some = right.where("s = 'a' AND k % 3 = 0").select("k", "v")
    got = sifted_join(left, some, "k", words)
    assert Counter(map(tuple, got.select("k", "s", "i", "v").collect())) == Counter(map(tuple, left.join(some, "k", "left").select("k", "s", "i", "v").collect()))


def test_sift_passes_few_others(spark):
    ids = spark.range(0, 50_000, 5).toDF("id")
    marked = sift(spark.range(50_000).toDF("key"), "key", ids)
    few = marked.groupBy((F.col("key") % 5 == 0).alias("is_in")).agg(F.count_if("__may").alias("may"), F.count("*").alias("n"))
    got = {r["is_in"]: (r["may"], r["n"]) for r in few.collect()}
    assert got[True] == (10_000, 10_000)
    assert got[False][0] < 0.12 * got[False][1]
    assert sift(spark.range(5).toDF("key"), "key", ids.limit(0)).where("__may").count() == 0


def test_lookup_of_a_hot_code(spark):
    """A third of all records on one code, a tenth without any, and no codemap that may be broadcast."""
    from docmart.operators.lookup import lookup, lookup_split

    rows = spark.range(30_000).select(
        F.col("id").alias("record"),
        F.lit("S").alias("system"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 > 0, (F.col("id") % 4000).cast("string")).alias("code"),
    ).repartition(8, "record")
    codemap = spark.range(3000).select(F.lit("S").alias("code_system"), F.col("id").cast("string").alias("code"), F.col("id").alias("concept_id"))
    codemap = codemap.union(spark.createDataFrame([("S", "hot", -1)], "code_system string, code string, concept_id long"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = lookup_split(rows, codemap, "system", "code", "concept")
        sizes = sorted(n for n in got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n)
        assert got.columns == [*rows.columns, "concept"]
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, lookup(rows, codemap, "system", "code", "concept").select(*got.columns).collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    shuffled = [n for n in sizes if n > 500]
    assert max(sizes) < 5000  # the hot code alone has ten thousand rows
    assert len(shuffled) >= 8 and "SortMergeJoin" in plan and "BroadcastHashJoin" in plan


def test_table_with_split_codes(spark, sf):
    from docmart.plans import clinical as C
    from docmart.plans.pipeline import convert

    job = convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf))
    plain, split = (Counter(map(tuple, job.table("drug", s).collect())) for s in (False, True))
    assert plain == split and sum(plain.values()) > 1000
    job.drop_stage()
