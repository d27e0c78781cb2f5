"""Command line: the batch jobs as spark-submit friendly commands.

    python -m weblex extract-hosts MANIFEST OUT [--base P] [--limit-files N] [--limit-rows N]
    python -m weblex extract-urls  MANIFEST OUT [--base P] [--limit-files N] [--limit-rows N]
    python -m weblex normalize     HOSTS OUT [--in-order]
    python -m weblex term-frequency URLS OUT [--percentage 0.8] [--max-domains 1000]
                                   [--min-term-length 3] [--sample-rate N] [--first-seen]
    python -m weblex term-frequency-incremental URL_DIR OUT --state-dir DIR [...]

Inputs are paths Spark reads (text line files, a gzipped manifest of
Parquet index files); outputs are Spark folders of text lines, the reports
as ``term,frequency,"domains"`` lines under a ``term,frequency,domains``
header, part files in report order.  Suffix rules: the ICANN list that the
package holds, or ``--suffix-list PATH`` (a public suffix list on storage every
machine reads); URLs under suffixes a list lacks are dropped.
"""

from __future__ import annotations

import argparse
import os
import sys


def _rules(spark, args):
    from .sources.suffixes import builtin_rules, read_suffix_rules
    extra = list(args.extra_suffix or [])
    if args.suffix_list:
        return read_suffix_rules(spark, args.suffix_list, private=args.private_suffixes, extra=extra)
    return builtin_rules(spark, extra)


def _extract(spark, args, hosts: bool) -> None:
    from .plans import jobs
    from .sinks import write_lines
    from .sources import index as idx
    paths = idx.read_manifest(spark, args.manifest, args.base, args.limit_files)
    skipped: list[tuple[str, str]] = []
    index = idx.read_index(spark, paths, args.limit_rows, args.tolerant, skipped)
    for path, reason in skipped:
        print(f"skipped {path}: {reason}", file=sys.stderr)
    out = jobs.extract_hosts(index) if hosts else jobs.extract_urls(index)
    col = "host" if hosts else "url"
    write_lines(out, col, args.output)


def _normalize(spark, args) -> None:
    from .plans import jobs
    from .sinks import write_lines
    from .operators.dedup import SPLIT
    from .sources.lines import numbered_lines, read_lines
    rules = _rules(spark, args)
    if args.in_order:
        hosts = numbered_lines(spark, args.input, "host", keep_split=True).filter("host <> ''")
        out = jobs.normalize_domains_in_order(hosts, rules, "line_no", split=SPLIT)
        out = out.orderBy("line_no")
    else:
        out = jobs.normalize_domains(read_lines(spark, args.input, "host"), rules)
    write_lines(out, "domain", args.output)


def _urls(spark, args, ordered: bool):
    from .sources.lines import numbered_lines, read_lines, sample_every_nth
    if not ordered and args.sample_rate <= 1:
        return read_lines(spark, args.input, "url")
    # Every raw line counts, blank ones too; those are dropped afterwards.
    urls = sample_every_nth(numbered_lines(spark, args.input, "url"), args.sample_rate, "line_no")
    return urls.filter("url <> ''")


def _write_report(report, args) -> None:
    from .sinks import write_term_csv, write_term_report_file, write_term_report_text
    if args.single_file:
        write_term_report_file(report, args.output)
    elif args.spark_csv:
        write_term_csv(report, args.output)
    else:
        write_term_report_text(report, args.output)


def _term_frequency(spark, args) -> None:
    from .plans import jobs
    rules = _rules(spark, args)
    if args.first_seen:
        report = jobs.first_seen_term_frequency(
            _urls(spark, args, True), rules, "line_no", args.percentage,
            args.max_domains, args.min_term_length)
    else:
        report, stats = jobs.analyze(_urls(spark, args, False), rules, "url", args.percentage,
                                     args.max_domains, args.min_term_length)
        s = stats.first()
        print(f"Processed {s.processed_urls:,} URLs, {s.unique_domains:,} domains, "
              f"{s.unique_terms:,} terms, {s.total_terms:,} term occurrences")
    _write_report(report, args)


def _incremental(spark, args) -> None:
    from .streaming import incremental
    rules = _rules(spark, args)
    parts = os.path.join(args.state_dir, "partials")
    incremental.run_incremental(spark, args.input, parts, os.path.join(args.state_dir, "checkpoint"),
                                rules, args.min_term_length, args.max_files_per_batch,
                                sample_rate=args.sample_rate, compact_after=args.compact_after)
    s = incremental.run_stats(spark, parts).first()
    print(f"Processed {s.processed_urls:,} URLs, {s.unique_domains:,} domains, {s.unique_terms:,} terms, "
          f"{s.total_terms:,} term occurrences in {s.batches:,} batches")
    report = incremental.merged_report(spark, parts, args.percentage, args.max_domains)
    _write_report(report, args)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weblex", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    def suffix_opts(q):
        q.add_argument("--suffix-list", help="public suffix list file (any Spark path; "
                                             "default: the ICANN list of the package)")
        q.add_argument("--private-suffixes", action="store_true",
                       help="also use the PRIVATE section of the list")
        q.add_argument("--extra-suffix", action="append", help="extra plain suffix rule")

    for name in ("extract-hosts", "extract-urls"):
        q = sub.add_parser(name, help=f"distinct {name.split('-')[1]} per index file")
        q.add_argument("manifest")
        q.add_argument("output")
        q.add_argument("--base", default="", help="prefix for manifest paths")
        q.add_argument("--limit-files", type=int)
        q.add_argument("--limit-rows", type=int)
        q.add_argument("--tolerant", action="store_true", help="skip unreadable files")

    q = sub.add_parser("normalize", help="registered domains of a host list")
    q.add_argument("input")
    q.add_argument("output")
    q.add_argument("--in-order", action="store_true",
                   help="keep input order and drop adjacent repeats instead of a distinct set")
    suffix_opts(q)

    helps = {"term-frequency": "term report of a URL list",
             "term-frequency-incremental": "term report kept up to date as URL files arrive"}
    for name in ("term-frequency", "term-frequency-incremental"):
        q = sub.add_parser(name, help=helps[name])
        q.add_argument("input")
        q.add_argument("output")
        q.add_argument("--percentage", type=float, default=0.8,
                       help="share of all term occurrences the kept terms cover (default 0.8)")
        q.add_argument("--max-domains", type=int, default=1000,
                       help="domains listed per term (default 1000)")
        q.add_argument("--min-term-length", type=int, default=3,
                       help="minimum word and stem length (default 3)")
        q.add_argument("--single-file", action="store_true",
                       help="write the report as one file instead of a folder of parts")
        q.add_argument("--spark-csv", action="store_true",
                       help="write with Spark's CSV writer (quotes only when needed) instead "
                            "of the term,frequency,\"domains\" lines")
        suffix_opts(q)
        q.add_argument("--sample-rate", type=int, default=1,
                       help="use every Nth input line (default 1: all)")
        if name == "term-frequency":
            q.add_argument("--first-seen", action="store_true",
                           help="list each term's first domains in input order")
        else:
            q.add_argument("--state-dir", required=True,
                           help="partials and stream checkpoint (shared storage)")
            q.add_argument("--max-files-per-batch", type=int)
            q.add_argument("--compact-after", type=int,
                           help="merge the stored partials whenever this many batches are new")
    return p


def main(argv: list[str] | None = None) -> None:
    from .session import build_session
    args = parser().parse_args(argv)
    spark = build_session(app_name=f"weblex {args.command}")
    if args.command in ("extract-hosts", "extract-urls"):
        _extract(spark, args, args.command == "extract-hosts")
    elif args.command == "normalize":
        _normalize(spark, args)
    elif args.command == "term-frequency":
        _term_frequency(spark, args)
    else:
        _incremental(spark, args)


if __name__ == "__main__":
    main()
