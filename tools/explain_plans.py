"""Print the executed (final adaptive) physical plans of headline queries.

Usage:
    python tools/explain_plans.py [sf_dir] [name ...]     # plain plans
    python tools/explain_plans.py --markdown [sf_dir]     # PLANS.md content

Each query is run once (collect), then its final plan tree is printed
without the per-node detail section, so exchanges, joins and partial
aggregates show.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WIDTH = 150

NOTES = {
    "pairs": """* The stage after the round-robin read holds all per-URL work in one
  whole-stage-codegen span: strip, lenient host, suffix lookups (`INSET`),
  URL parts, `explode` (with the "has a domain" test inside its input), the
  F1-F3 filter and the partial `(word, domain)` count.  No filter copies the
  domain expression.
* The vocabulary branch reads the pair shuffle through `ReusedExchange`
  (the URLs are parsed once), sums it per word, and runs the Porter chain:
  one `Project` per step and the F4 test inside `Generate explode`, in the
  same codegen stage as the broadcast join and the partial `(term, domain)`
  aggregate.  No Python.
* The stem join is keyed on (word, salt): hot words (more than
  `HOT_PAIRS` pair rows; none at this size, so AQE dropped the empty
  hot-word join) would be spread over several tasks.  AQE broadcast the
  dictionary side from its measured size.
* `Exchange RoundRobinPartitioning(8)` is `spread`: the test table is one
  row group; on large inputs (more splits than task slots) it is not added.
""",
    "report": """* Reads only the stored table (`FileScan parquet`).
* Cutoff: terms above the boundary count (a filter) union the first tied
  terms at it (`TakeOrderedAndProject`), both from one small boundary action
  over the count histogram.
* Top domains: the kept-term semi join comes first, so the long tail is not
  ranked.  Then a limit a level: `WindowGroupLimit ... Partial` before the shuffle
  on (term, part of the term), the last on the term alone; about `FAN_IN` x N rows
  of a term meet in a task, and small tables have one level.
* The term-count shuffle is shared through `ReusedExchange`.
""",
    "q1_extract_hosts": """* Two scans (files spelling the column `url` and `URL`), each reading only
  that column and `_metadata.file_path`; the host is computed once per row
  and rows without a host are dropped inside the `inline` generator.
* One shuffle on (file, host) after a partial distinct.
""",
    "d4_adjacent_dedup": """* No exchange over rows: each task sorts the rows of its input split and
  compares neighbours (`MapInArrow`).
* The broadcast table has a row per split: the last value of the nearest
  earlier split, read from a stored table of split edges.
""",
}

TITLES = {
    "pairs": "Q4, part 1: term x domain pair counts (stored once under the checkpoint folder)",
    "report": "Q4, part 2: report over the stored pair counts",
    "q1_extract_hosts": "Q1: distinct hosts per index file",
    "d4_adjacent_dedup": "D4: adjacent-run dedup without a global window",
}


def final_tree(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"== Final Plan ==\n(.*?)\+- == Initial Plan ==", plan, re.S)
    body = m.group(1) if m else plan
    return "\n".join(line.rstrip()[:WIDTH] for line in body.split("\n") if line.strip())


def plans(spark, sf_dir: str, names: list[str]) -> dict[str, str]:
    from weblex.operators import terms
    from weblex.plans import catalog, jobs
    from weblex.plans.materialize import materialize
    from weblex.sources.pages import link_corpus
    from weblex.sources.suffixes import fixture_rules

    pairs = terms.term_domain_counts(terms.url_words(link_corpus(spark, sf_dir), fixture_rules(spark)))
    out = {"pairs": final_tree(pairs)}
    out["report"] = final_tree(jobs.term_report(materialize(pairs, "explain-td"), 0.8, 1000))
    for name in names:
        out[name] = final_tree(catalog.QUERIES[name](spark, sf_dir))
    return out


def main() -> None:
    from weblex.session import build_session

    args = sys.argv[1:]
    markdown = "--markdown" in args
    args = [a for a in args if a != "--markdown"]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or ["q1_extract_hosts", "d4_adjacent_dedup"]
    spark = build_session("local[8]", 16)
    found = plans(spark, sf_dir, names)
    if not markdown:
        for name, tree in found.items():
            print(f"## {name}\n\n{tree}\n")
        return
    print(f"# Executed plans ({os.path.basename(sf_dir.rstrip('/'))}, local[8], 16 shuffle partitions)\n")
    print("Produced by `python tools/explain_plans.py --markdown`: the final adaptive")
    print(f"plans after a run, node details cut at {WIDTH} characters.  What to look for")
    print("is listed above each plan.\n")
    for name, tree in found.items():
        print(f"## {TITLES.get(name, name)}\n")
        if name in NOTES:
            print(NOTES[name])
        print(f"```\n{tree}\n```\n")


if __name__ == "__main__":
    main()
