"""Stem dictionary over the distinct vocabulary, joined back.

Each distinct word is stemmed once per corpus; the word -> term table is
joined back with an equi-join that AQE broadcasts when its measured size is
small.  The stemmer is Porter's algorithm (extended rules; ``extended=False``
gives those of 1980) written as a chain of built-in
SQL expressions (``functions.porter_sql``), so it runs JVM-side in
whole-stage codegen.

Two plan details keep the chain cheap:
  * each step is its own projection reading the previous step several
    times, so the optimizer does not inline steps into each other;
  * the minimum stem length (F4) is tested inside an ``explode`` input, not
    by a filter: a filter on the stem would be pushed down through every
    step with the step's expression substituted, growing the plan
    geometrically.
The Python implementation (``functions.porter.stem``, ``method="python"``,
run through ``mapInPandas``) is the reference the tests compare against.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.porter import stem
from ..functions.porter_sql import porter_steps
from ..session import ship_package


def vocabulary(words: DataFrame, word_col: str = "word",
               weight: str | None = None) -> DataFrame:
    """(word, rows, pairs): per-word total (sum of ``weight``, or rows) and
    number of input rows.

    The total is read by the stemming step, so it is not pruned, and keeps
    this aggregate on top of its input: a plain distinct over a
    (word, domain, n) aggregate would be rewritten into a second pass over
    the raw words, while summing that aggregate's own count column keeps
    the branches identical and its shuffle output is reused.
    """
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return words.groupBy(F.col(word_col).alias("word")).agg(
        total.alias("rows"), F.count(F.lit(1)).alias("pairs"))


def guard(vocab: DataFrame) -> Column:
    """A condition true for every vocabulary row that reads its total, so that
    branches over the vocabulary keep the same input aggregate and share its
    shuffle (see ``vocabulary``)."""
    return F.col("rows") > 0


def stem_vocabulary(vocab: DataFrame, min_len: int = 1, method: str = "sql",
                    keep: tuple[str, ...] = (), extended: bool = True) -> DataFrame:
    """(word, term, keep...) for a vocabulary table (word, rows, ...)."""
    if method == "python":
        return _python_stems(vocab, min_len, keep, extended)
    init, steps, final = porter_steps("spark", extended=extended)
    df = vocab.withColumn("w", F.expr(init))
    for expr in steps:
        df = df.withColumn("w", F.expr(expr))
    df = df.withColumn("term", F.expr(final))
    ok = (F.length("term") >= min_len) & guard(vocab)
    return df.select("word", F.explode(F.when(ok, F.array("term"))).alias("term"), *keep)


def stem_dictionary(words: DataFrame, word_col: str = "word", min_len: int = 1,
                    weight: str | None = None, method: str = "sql", extended: bool = True) -> DataFrame:
    """Distinct words -> (word, term); words whose stem is shorter than
    ``min_len`` are dropped (F4).  ``weight``: a count column of ``words``."""
    return stem_vocabulary(vocabulary(words, word_col, weight), min_len, method, extended=extended)


def _python_stems(vocab: DataFrame, min_len: int, keep: tuple[str, ...] = (), extended: bool = True) -> DataFrame:
    ship_package(vocab.sparkSession)
    fields = dict(vocab.dtypes)
    schema = ", ".join(["word string", "term string"] + [f"{k} {fields[k]}" for k in keep])

    def stem_batches(batches):
        for pdf in batches:
            out = pd.DataFrame({"word": pdf["word"], "term": pdf["word"].map(lambda w: stem(w, extended)),
                                **{k: pdf[k] for k in keep}})
            out = out[pdf["rows"].to_numpy() > 0]
            yield out[out["term"].str.len() >= min_len]

    return vocab.mapInPandas(stem_batches, schema)
