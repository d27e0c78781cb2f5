"""D4 run dedup (edge row, bucket-size independence), D1/D5, A2."""

import random

import pytest
from pyspark.sql import functions as F

from weblex.operators import counts, dedup


def runs(spark, values, bucket):
    df = spark.createDataFrame(list(enumerate(values)), "ord long, v string")
    out = dedup.drop_adjacent_repeats(df, "v", "ord", bucket_rows=bucket)
    return [r.v for r in out.orderBy("ord").collect()]


def sequential(values):
    out, prev = [], None
    for v in values:
        if v is None:
            continue
        if v != prev:
            out.append(v)
        prev = v
    return out


def test_run_dedup_edge(spark):
    assert runs(spark, ["a", "a", None, "a", "b", "a"], 1000) == ["a", "b", "a"]


@pytest.mark.parametrize("bucket", [1, 2, 3, 7, 1000])
def test_run_dedup_bucket_independent(spark, bucket):
    rnd = random.Random(bucket)
    values = [rnd.choice(["a", "b", None, None]) for _ in range(200)]
    assert runs(spark, values, bucket) == sequential(values)


def in_place(spark, path, split=True):
    from weblex.sources.lines import numbered_lines
    lines = numbered_lines(spark, path, "v", keep_split=True)
    lines = lines.withColumn("v", F.when(F.col("v") != "", F.col("v")))
    return dedup.drop_adjacent_repeats(lines, "v", "line_no", split=dedup.SPLIT if split else None)


@pytest.mark.parametrize("split_bytes", [40, 300, 1 << 20])
def test_run_dedup_where_the_lines_are(spark, tmp_path, split_bytes):
    rnd = random.Random(split_bytes)
    values = []
    while len(values) < 900:  # runs over several splits, splits without any value
        values += [rnd.choice(["a", "b", "", "ü"])] * rnd.choice([1, 2, 40])
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text("\n".join(values[300 * k:300 * k + 300]) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        out = in_place(spark, str(tmp_path))
        got = [r.v for r in sorted(out.collect(), key=lambda r: r.line_no)]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sequential([v or None for v in values[:900]])
    rows = plan.split("MapInArrow")[1]  # what the compared rows come from
    assert "Exchange hashpartitioning" not in rows.split("BroadcastExchange")[0] and "Window" not in rows.split("BroadcastExchange")[0]


def test_run_dedup_of_interleaved_splits(spark, tmp_path):
    values = ["a", "a", "b", None, "b", "a", "c", "c"] * 30
    df = spark.createDataFrame(list(enumerate(values)), "ord long, v string").repartition(4)
    df.write.parquet(str(tmp_path / "t"))
    read = dedup.with_split(spark.read.parquet(str(tmp_path / "t")).select("ord", "v"))
    out = dedup.drop_adjacent_repeats(read, "v", "ord", split=dedup.SPLIT)
    assert out.columns == ["ord", "v"]
    assert [r.v for r in out.orderBy("ord").collect()] == sequential(values)
    none = dedup.drop_adjacent_repeats(read.filter("ord < 0"), "v", "ord", split=dedup.SPLIT)
    assert none.count() == 0


def test_distinct_per_file_and_counts(spark):
    df = spark.createDataFrame([("f1", "a"), ("f1", "a"), ("f1", None), ("f2", "a")],
                               "file_path string, host string")
    d = dedup.distinct_per_file(df, "host")
    assert sorted(tuple(r) for r in d.collect()) == [("f1", "a"), ("f2", "a")]
    assert sorted(tuple(r) for r in counts.rows_per_file(d).collect()) == [("f1", 1), ("f2", 1)]


def test_union_all_and_hash_sample(spark):
    from weblex.sources.lines import hash_sample
    a = spark.createDataFrame([("x", 1)], "k string, n long")
    b = spark.createDataFrame([(2, "y")], "n long, k string")
    assert sorted(tuple(r) for r in dedup.union_all([a, b]).collect()) == [("x", 1), ("y", 2)]
    df = spark.range(2000).selectExpr("cast(id as string) as url")
    s1, s2 = hash_sample(df, 4).collect(), hash_sample(df, 4).collect()
    assert s1 == s2 and 350 < len(s1) < 650
    assert hash_sample(df, 1).count() == 2000
