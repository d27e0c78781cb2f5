"""The command line on small inputs derived from the test tables."""

import os

from pyspark.sql import functions as F

from weblex import cli
from weblex.session import scratch_path
from weblex.sinks import read_term_csv
from weblex.sources.pages import link_corpus
from weblex.sources import index as idx
from conftest import SF_SMALL


def test_cli_commands(spark):
    root = scratch_path(spark, "cli")
    urls = os.path.join(root, "urls")
    link_corpus(spark, SF_SMALL).orderBy("page_id", "pos").select("url").coalesce(1).write.text(urls)
    rules = ["--extra-suffix", "example.com", "--extra-suffix", "example.net",
             "--extra-suffix", "example.org"]

    out = os.path.join(root, "report")
    cli.main(["term-frequency", urls, out, *rules])
    report = read_term_csv(spark, out).collect()
    assert report and report[0].frequency >= report[-1].frequency

    first = os.path.join(root, "first")
    cli.main(["term-frequency", urls, first, "--first-seen", "--sample-rate", "2", *rules])
    assert read_term_csv(spark, first).count() > 0

    manifest = idx.write_manifest(spark, [idx.local_table_path(SF_SMALL, "pages"), "x.txt"],
                                  os.path.join(root, "manifest"))
    hosts = os.path.join(root, "hosts")
    cli.main(["extract-hosts", manifest, hosts])
    host_rows = spark.read.text(hosts).count()
    assert host_rows == spark.read.parquet(idx.local_table_path(SF_SMALL, "pages")) \
        .select(F.regexp_extract("url", "^https?://([^/:]+)", 1)).distinct().count()

    domains = os.path.join(root, "domains")
    cli.main(["normalize", hosts, domains, *rules])
    runs = os.path.join(root, "runs")
    cli.main(["normalize", hosts, runs, "--in-order", *rules])
    assert spark.read.text(domains).count() <= spark.read.text(runs).count() <= host_rows

    inc = os.path.join(root, "inc-report")
    cli.main(["term-frequency-incremental", urls, inc, "--state-dir", os.path.join(root, "state"), *rules])
    assert sorted(map(tuple, read_term_csv(spark, inc).collect())) == sorted(map(tuple, report))
