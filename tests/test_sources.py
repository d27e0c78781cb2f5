"""S1-S5, S7, K1/K2 round trips."""

import os

import pytest

from pyspark.sql import functions as F

from weblex.session import scratch_path
from weblex.sinks import read_term_csv, write_lines, write_term_csv, write_term_report_text
from weblex.sources import index as idx
from weblex.sources.lines import numbered_lines, read_lines, sample_every_nth
from conftest import SF_SMALL


def jobs_of(spark, run):
    """(result, number of Spark jobs)."""
    sc, group = spark.sparkContext, os.urandom(6).hex()
    sc.setJobGroup(group, "counted")
    try:
        return run(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_resolve_url_column():
    assert idx.resolve_url_column(["URL", "Uri"]) == "URL"
    assert idx.resolve_url_column(["x", "Uri", "uri"]) == "uri"
    assert idx.resolve_url_column(["link"]) is None


def test_manifest_limit_counts_non_parquet(spark):
    path = scratch_path(spark, "manifest")
    idx.write_manifest(spark, [" a.parquet ", "notes.txt", "b.parquet", "c.parquet"], path)
    assert idx.read_manifest(spark, path, "base/", 3) == ["base/a.parquet", "base/b.parquet"]
    assert idx.read_manifest(spark, path) == ["a.parquet", "b.parquet", "c.parquet"]


def test_read_index_columns_limits_and_tolerance(spark):
    root = scratch_path(spark, "idx")
    spark.createDataFrame([(i, f"http://h{i % 3}.com/{i}") for i in range(10)], "i long, URL string") \
        .coalesce(1).write.parquet(os.path.join(root, "upper.parquet"))
    spark.createDataFrame([(1, "x")], "i long, link string").write.parquet(os.path.join(root, "none.parquet"))
    spark.createDataFrame([("not parquet",)], "value string").write.text(os.path.join(root, "bad.parquet"))
    paths = [os.path.join(root, p) for p in ["upper.parquet", "none.parquet", "bad.parquet", "gone.parquet"]]
    skipped = []
    df = idx.read_index(spark, paths, limit_rows=4, tolerant=True, skipped=skipped)
    assert [os.path.basename(p) for p, _ in skipped] == ["bad.parquet", "gone.parquet"]
    assert all(reason for _, reason in skipped)
    assert sorted(r.url for r in df.collect()) == sorted(f"http://h{i % 3}.com/{i}" for i in range(4))


def test_tolerant_scan_lists_bad_pages_and_part_files(spark, tmp_path, monkeypatch):
    from pathlib import Path
    root = tmp_path / "idx"
    made = {}
    for i, name in enumerate(["good", "page", "folder"]):
        spark.range(3000).selectExpr(f"concat('http://h', id * 7919 % 3001, '.com/{i}/', md5(string(id))) AS url") \
            .repartition(3 if name == "folder" else 1).write.parquet(f"{root}/{name}.parquet")
        made[name] = sorted(Path(f"{root}/{name}.parquet").glob("part-*.parquet"))
    page, part = made["page"][0], made["folder"][1]
    data = bytearray(page.read_bytes())
    data[2000:len(data) - 2000] = b"\xff" * (len(data) - 4000)  # the footer stays good
    page.write_bytes(bytes(data))
    part.write_bytes(b"no parquet at all")
    for f in (page, part):
        f.with_name(f".{f.name}.crc").unlink()
    left = 3000 + sum(spark.read.parquet(str(f)).count() for f in made["folder"] if f != part)

    skipped = []
    entries = [f"{root}/{name}.parquet" for name in made]
    df = idx.read_index(spark, entries, tolerant=True, skipped=skipped)
    assert sorted(os.path.basename(p) for p, _ in skipped) == sorted([page.name, part.name])
    assert all(reason for _, reason in skipped)
    assert df.where("url is not null").count() == left
    only = []
    good, jobs = jobs_of(spark, lambda: idx.read_index(spark, entries[:2], tolerant=True, skipped=only))
    assert good.count() == 3000 and [os.path.basename(p) for p, _ in only] == [page.name]
    # A bad file more costs no job more; one that is too large to be handed to
    # a task whole is asked by itself.
    every, more = jobs_of(spark, lambda: idx.read_index(spark, entries, tolerant=True))
    assert every.where("url is not null").count() == left and more == jobs
    monkeypatch.setattr(idx, "CHECK_BYTES", 100)
    again = []
    assert idx.read_index(spark, entries, tolerant=True, skipped=again).count() == left
    assert sorted(p for p, _ in again) == sorted(p for p, _ in skipped)
    with pytest.raises(Exception):
        idx.read_index(spark, entries[1:2]).agg(F.max("url")).collect()


def test_a_thousand_files_of_mixed_spellings(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    def write(folder, n):
        (tmp_path / folder).mkdir()
        want, paths = [], []
        for i in range(n):
            url = f"http://h{i}.com/"
            names = [idx.URL_COLUMNS[i % 6]] if i % 7 else ["x", "uRl"] if i % 2 else ["Uri", "URL", "url"]
            cols = {c: [f"{url}{c}", None] for c in names}
            if "url" in names:
                cols["url"] = [None, url]  # the first name counts, whatever it holds
            col = idx.resolve_url_column(names)
            want += [(f"{i}.parquet", u) for u in (cols[col] if col else [])]
            # Other columns of the same name differ in type.
            cols["n"] = [1, 2] if i % 3 else ["a", "b"]
            path = str(tmp_path / folder / f"{i}.parquet")
            pq.write_table(pa.table(cols), path)
            paths.append(path)
        return want, paths

    found = []
    for folder, n in (("few", 300), ("many", 1000)):
        want, paths = write(folder, n)
        index, jobs = jobs_of(spark, lambda: idx.read_index(spark, paths))
        got = index.select(F.regexp_extract("file_path", "([^/]+)$", 1), "url").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        found.append(jobs)
    assert found[0] == found[1] < 20
    # Used within a plan of the caller's session, which does not tell case apart.
    other = spark.createDataFrame([("http://h0.com/", 5)], "url string, n int")
    assert [r.n for r in other.join(index, "url").collect()] == [5]
    limited = idx.read_index(spark, paths[:50], limit_rows=1).where("url is not null")
    assert limited.count() == sum(u is not None for u in [u for f, u in want if int(f.split(".")[0]) < 50][::2])


def test_errors_that_are_no_bad_page():
    wrapped = ("org.apache.parquet.io.ParquetDecodingException", "could not read page")
    assert idx._bad_page([("org.apache.spark.SparkException", "task failed"), wrapped])
    assert not idx._bad_page([wrapped, ("java.net.SocketException", "Connection reset")])
    assert not idx._bad_page([("org.apache.spark.SparkException", "lost"), ("java.io.IOException", "Filesystem closed")])


def test_read_lines_and_sampling(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(f"  u{i}  ",) for i in range(1, 8)] + [("   ",)], "value string") \
        .coalesce(1).write.text(path)
    assert read_lines(spark, path, "url").count() == 7
    numbered = numbered_lines(spark, path, "url")
    assert [r.url for r in numbered.orderBy("line_no").collect()] == [f"u{i}" for i in range(1, 8)] + [""]
    picked = sample_every_nth(numbered, 3, "line_no")
    assert sorted(r.url for r in picked.collect()) == ["u3", "u6"]
    assert sample_every_nth(numbered, 1, "line_no").count() == 8


def test_blank_lines_count_in_sampling(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(v,) for v in ("a", "", "b", "c", "", "d")], "value string").coalesce(1).write.text(path)
    picked = sample_every_nth(numbered_lines(spark, path, "url"), 2, "line_no").filter("url <> ''")
    assert sorted(r.url for r in picked.collect()) == ["c", "d"]


def test_line_numbers_over_many_splits(spark):
    path = scratch_path(spark, "lines")
    spark.range(5000).select(F.format_string("%06d", "id").alias("value")).repartitionByRange(4, "value") \
        .sortWithinPartitions("value").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        numbered = numbered_lines(spark, path, "url")
        assert numbered.rdd.getNumPartitions() > 8
        assert all(int(r.url) + 1 == r.line_no for r in numbered.collect())
        plan = numbered._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" not in plan and "Sort" not in plan.split("Join")[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sinks_round_trip(spark):
    df = spark.createDataFrame([("a.com",), ("b.com",)], "domain string")
    out = write_lines(df, "domain", scratch_path(spark, "k1"))
    assert sorted(r.domain for r in read_lines(spark, out, "domain").collect()) == ["a.com", "b.com"]
    rep = spark.createDataFrame([("t", 5, "a.com,b.com"), ("u", 9, "c.com")],
                                "term string, frequency bigint, domains string")
    back = read_term_csv(spark, write_term_csv(rep, scratch_path(spark, "k2")))
    assert [tuple(r) for r in back.collect()] == [("u", 9, "c.com"), ("t", 5, "a.com,b.com")]


def test_reports_read_back_with_quotes(spark):
    rows = [("alpha", 3, 'a"b.com,plain.com'), ("beta", 2, '"'), ("gamma", 1, "x.com")]
    rep = spark.createDataFrame(rows, "term string, frequency bigint, domains string")
    for write in (write_term_csv, write_term_report_text):
        back = read_term_csv(spark, write(rep, scratch_path(spark, "k2-quotes")))
        assert [tuple(r) for r in back.collect()] == rows


def test_page_corpus(spark):
    from weblex.sources.pages import link_corpus
    links = link_corpus(spark, SF_SMALL)
    assert links.columns == ["page_id", "pos", "url"]
    assert links.filter(~F.col("url").startswith("http://")).count() == 0


def test_sample_in_split(spark):
    from weblex.sources.lines import sample_every_nth_in_split
    df = spark.range(0, 70, numPartitions=7)  # ranges of 10 rows
    got = sorted(r.id for r in sample_every_nth_in_split(df, 3).collect())
    assert got == sorted(base + k for base in range(0, 70, 10) for k in (2, 5, 8))
    assert sample_every_nth_in_split(df, 1).count() == 70


def test_files_of_one_column_keep_their_paths(spark):
    root = scratch_path(spark, "fast")
    for i in range(3):
        spark.createDataFrame([(f"http://h{i}.com/{j}",) for j in range(5)], "url string") \
            .write.parquet(os.path.join(root, f"f{i}.parquet"))
    spark.createDataFrame([(1,)], "x long").write.parquet(os.path.join(root, "nourl.parquet"))
    paths = [os.path.join(root, p) for p in ["f0.parquet", "f1.parquet", "f2.parquet", "nourl.parquet"]]
    assert idx._by_column(idx._exact_session(spark), paths) == {"url": paths}
    assert idx.read_index(spark, paths).filter("url is not null").count() == 15


def test_report_text_format(spark):
    from weblex.sinks import write_term_report_text
    rep = spark.createDataFrame([("t", 5, "a.com,b.com"), ("u", 9, "c.com"), ("a", 5, "d.com")],
                                "term string, frequency bigint, domains string")
    out = write_term_report_text(rep, scratch_path(spark, "k2text")).replace("file:", "")
    lines = []
    for name in sorted(f for f in os.listdir(out) if f.startswith("part-")):
        with open(os.path.join(out, name)) as fh:
            lines += fh.read().splitlines()
    assert lines == ["term,frequency,domains", 'u,9,"c.com"', 'a,5,"d.com"', 't,5,"a.com,b.com"']
    back = read_term_csv(spark, out)
    assert sorted(map(tuple, back.collect())) == [("a", 5, "d.com"), ("t", 5, "a.com,b.com"), ("u", 9, "c.com")]


def test_single_files_equal_a_sequential_writer(spark, tmp_path, monkeypatch):
    from weblex import sinks
    rows = [(f"t{i % 97:02d}x{i}", 1 + i % 7, f'd{i}.com,"q{i}".org') for i in range(500)] + [("ü", 9, "ä.de")]
    rep = spark.createDataFrame(rows, "term string, frequency bigint, domains string").repartition(5)
    want = "term,frequency,domains\n"
    for term, n, domains in sorted(rows, key=lambda r: (-r[1], r[0].encode())):
        quoted = domains.replace('"', '""')
        want += f'{term},{n},"{quoted}"\n'
    target = tmp_path / "report.csv"
    sinks.write_term_report_file(rep, str(target))
    assert target.read_bytes() == want.encode()
    assert sorted(map(tuple, read_term_csv(spark, str(target)).collect())) == sorted(rows)
    lines = tmp_path / "hosts.txt"
    sinks.write_single_lines(rep.orderBy("term"), "term", str(lines))
    assert lines.read_bytes() == "".join(f"{t}\n" for t in sorted((r[0] for r in rows), key=str.encode)).encode()
    # A run that fails midway leaves the earlier report, and no other file.
    before = sorted(p.name for p in tmp_path.iterdir())
    broken = rep.withColumn("domains", F.when(F.col("term") == "ü", F.raise_error(F.lit("lost"))).otherwise(F.col("domains")))
    with pytest.raises(Exception):
        sinks.write_term_report_file(broken, str(target))
    with pytest.raises(Exception):
        sinks.join_parts(spark, str(tmp_path / "nothing"), str(tmp_path / "new.csv"))
    assert sorted(p.name for p in tmp_path.iterdir()) == before and target.read_bytes() == want.encode()
