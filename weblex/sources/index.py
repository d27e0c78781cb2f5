"""Crawl-index manifests and index files with a URL column.

A manifest is a (usually gzipped) text file, one index-file path per line.
Index files are Parquet with any columns; the URL column is the first name,
matched with exact case, out of URL_COLUMNS.  A file without one
contributes no rows.  Only that column is read (column pruning), and a
per-file row limit is a filter on the reader's row index, pushed into the
scan.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.materialize import materialize

PROBE_THREADS = 8

# FIXED VALUES: candidate URL column names, probed in this order, exact case.
URL_COLUMNS = ["url", "URL", "uri", "URI", "Url", "Uri"]


def write_manifest(spark: SparkSession, entries: list[str], path: str) -> str:
    """Write a gzipped manifest (one entry per line, order kept)."""
    df = spark.createDataFrame([(e,) for e in entries], "value string").coalesce(1)
    df.write.mode("overwrite").option("compression", "gzip").text(path)
    return path


def read_manifest(spark: SparkSession, path: str, base: str = "",
                  limit_files: int | None = None) -> list[str]:
    """Index paths of a manifest.

    Lines are stripped; the first ``limit_files`` lines are taken (when
    > 0) in file order, *then* non-.parquet entries are dropped (they still
    count toward the limit); each path is prefixed with ``base``.  The
    manifest is a short list, read whole.
    """
    # The manifest is a list of file names (hundreds of lines), needed on
    # the driver to plan the scan; it is read whole to keep line order.
    lines: list[str] = []
    for r in spark.read.text(path, wholetext=True).select("value").collect():
        lines.extend(r["value"].splitlines())
    lines = [ln.strip() for ln in lines]
    if limit_files and limit_files > 0:
        lines = lines[:limit_files]
    return [base + ln for ln in lines if (base + ln).endswith(".parquet")]


def resolve_url_column(columns: list[str]) -> str | None:
    """First exact-case match among URL_COLUMNS, else None."""
    for c in URL_COLUMNS:
        if c in columns:
            return c
    return None


#: What a file without a column reads as in the catalogue (no URL holds a NUL).
ABSENT = "\x00no such column"
#: Files up to this many bytes are handed to a task whole to say what is wrong.
CHECK_BYTES = 512 << 20


def _reader(spark: SparkSession, tolerant: bool):
    # Index entries are files (or folders) from anywhere: no partition
    # inference from folder names, which could conflict between entries.
    reader = spark.read.option("recursiveFileLookup", "true")
    if tolerant:
        reader = (reader.option("ignoreCorruptFiles", "true")
                        .option("ignoreMissingFiles", "true"))
    return reader


def _exact_session(spark: SparkSession) -> SparkSession:
    """A child session in which column names are told apart by case.  Scans
    made in it read that way wherever they are used; the caller's session is
    never changed."""
    child = spark.newSession()
    child.conf.set("spark.sql.caseSensitive", "true")
    child.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    child.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return child


def _column_scan(exact: SparkSession, paths: list[str], col: str, tolerant: bool = False) -> DataFrame:
    """(file_path, row_index, url): one column of index files, as text."""
    rows = _reader(exact, tolerant).schema(StructType([StructField(col, StringType())])).parquet(*paths)
    return rows.select(F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.row_index").alias("row_index"), F.col(f"`{col}`").alias("url"))


def url_columns(exact: SparkSession, paths: list[str], tolerant: bool = False) -> DataFrame:
    """S2, as a table: (file_path, column, n), the URL column (null: none) and
    the number of rows of each file that has rows, from one job.

    Tasks read footers only.  A branch per name keeps the rows of files that
    lack the column, which read as ABSENT: the filter skips every row group of
    the others by its statistics, and a missing column takes no reading."""
    default = {k: "'" + ABSENT + "'" for k in ("EXISTS_DEFAULT", "CURRENT_DEFAULT")}
    schema = StructType([StructField(c, StringType(), True, default) for c in URL_COLUMNS])
    files = _reader(exact, tolerant).schema(schema).parquet(*paths)
    file = F.col("_metadata.file_path").alias("file_path")
    rows = files.select(file, F.lit(0).alias("bit"))
    for i, c in enumerate(URL_COLUMNS):
        rows = rows.unionByName(files.where(F.col(c) == ABSENT).select(file, F.lit(1 << i).alias("bit")))
    column = F.lit(None).cast("string")
    for i, c in reversed(list(enumerate(URL_COLUMNS))):
        column = F.when(F.col("absent").bitwiseAND(1 << i) == 0, F.lit(c)).otherwise(column)
    return (rows.groupBy("file_path").agg(F.bit_or("bit").alias("absent"),
                                          F.sum((F.col("bit") == 0).cast("long")).alias("n"))
            .select("file_path", column.alias("column"), "n"))


def _as_path(uri: str) -> str:
    """The path of a file as Spark names it, to be read as it stands."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _same(uri: str) -> str:
    """``file:///x`` as ``file:/x``: Spark writes either."""
    return re.sub(r"^([\w+.-]+):///", r"\1:/", uri)


# What Spark says of pages that cannot be read: classes and messages in the
# chain of causes.  Those of ELSEWHERE go first, as Parquet's exceptions wrap
# them, too.
ELSEWHERE = ("java.net.", "javax.net.", "javax.security.", "java.nio.channels.", "java.nio.file.AccessDenied",
             "org.apache.hadoop.security.", "org.apache.hadoop.ipc.", "org.apache.hadoop.net.",
             "java.lang.OutOfMemoryError", "java.lang.Interrupted", "java.io.InterruptedIO")
BAD_PAGE = ("org.apache.parquet.", "org.xerial.snappy.", "com.github.luben.zstd.", "java.util.zip.",
            "java.lang.IllegalArgumentException", "java.lang.IndexOutOfBounds", "java.lang.ArrayIndexOutOfBounds",
            "java.lang.NegativeArraySize", "java.nio.Buffer", "java.io.FileNotFoundException")
BAD_PAGE_SAYS = ("can not read class org.apache.parquet", "FAILED_TO_UNCOMPRESS", "Reached the end of stream",
                 "is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "FILE_NOT_EXIST")


def _causes(e: Exception) -> list[tuple[str, str]]:
    """(class, message) of a Java error and its causes, the outermost first."""
    java, out = getattr(e, "java_exception", None) or getattr(e, "_origin", None), []
    while java is not None and len(out) < 30:
        out.append((java.getClass().getName(), str(java.getMessage() or "")))
        java = java.getCause()
    return out


def _bad_page(causes: list[tuple[str, str]]) -> str:
    """Why a file's pages cannot be read; '' if the error is another one."""
    if any(kind.startswith(ELSEWHERE) for kind, _ in causes):
        return ""
    for kind, says in reversed(causes):
        if kind.startswith(BAD_PAGE) or any(x in says for x in BAD_PAGE_SAYS):
            return f"{kind.rsplit('.', 1)[-1]}: {(says.splitlines() or [''])[0][:200]}"
    return ""


def _each(fn: Callable, items: list) -> list:
    with ThreadPoolExecutor(max_workers=PROBE_THREADS) as pool:
        return list(pool.map(fn, items))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).globStatus(p))


def _by_column(exact: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by URL column, as many rows on the driver as there are files.  If
    they share one, the paths stay as they are (a file without a URL column
    reads as nulls, which are dropped)."""
    groups: dict[str, list[str]] = {}
    for r in url_columns(exact, paths).where("column IS NOT NULL").select("file_path", "column").collect():
        groups.setdefault(r["column"], []).append(_as_path(r["file_path"]))
    if len(groups) == 1:
        return {c: list(paths) for c in groups}
    return {c: sorted(groups[c]) for c in URL_COLUMNS if c in groups}


def _decode(batches):
    """A task's check of whole files (path, content): (path, reason), '' for a
    file that can be read."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    for batch in batches:
        reasons = []
        for content in batch.column(1):
            try:
                file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                col = resolve_url_column(file.schema_arrow.names)
                for i in range(file.num_row_groups if col else 0):
                    file.read_row_group(i, columns=[col], use_threads=False)
                reasons.append("")
            except (pa.ArrowException, OSError, ValueError) as e:
                # The bytes are in memory: nothing but they can be at fault.
                reasons.append(f"{type(e).__name__}: {(str(e).splitlines() or [''])[0][:200]}")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(reasons)], names=["path", "reason"])


def _good_files(exact: SparkSession, paths: list[str], skipped: list[tuple[str, str]]) -> dict[str, list[str]]:
    """The readable files of ``paths`` by URL column; the others are added to
    ``skipped``.  As many jobs for any number of files, good or bad.

    One job lists columns and rows as footers tell them, the next counts the
    rows that can be read.  Both pass over errors of any kind.  A last one
    hands the files with a difference whole to tasks: Spark fetches the bytes
    (what a retry mends is no reason to leave a file out, what it doesn't is
    raised), and the task says whether the bytes can be decoded.
    """
    entries, there = paths, _each(lambda p: _exists(exact, p), paths)
    paths = [p for p, found in zip(entries, there) if found]
    missing = {p: "PATH_NOT_FOUND" for p, found in zip(entries, there) if not found}
    if not paths:
        skipped += missing.items()
        return {}
    told = materialize(url_columns(exact, paths, tolerant=True), "index-columns")
    groups: dict[str, list[str]] = {}
    known = {}
    for r in told.collect():
        known[_same(r["file_path"])] = r["column"]
        if r["column"]:
            groups.setdefault(r["column"], []).append(_as_path(r["file_path"]))
    files = sorted(_reader(exact, False).schema(f"`{URL_COLUMNS[0]}` string").parquet(*paths).inputFiles())
    doubtful = {_same(f) for f in files} - set(known)
    if groups:
        read = None
        for c, group in groups.items():
            part = _column_scan(exact, group, c, tolerant=True).select("file_path", F.length("url").alias("length"))
            read = part if read is None else read.unionByName(part)
        got = read.groupBy("file_path").agg(F.count(F.lit(1)).alias("got"), F.max("length").alias("longest"))
        short = (told.where("column IS NOT NULL").join(got, "file_path", "left")
                 .where("got IS NULL OR got <> n").select("file_path", "longest"))
        doubtful |= {_same(r["file_path"]) for r in short.collect()}
    bad = _reasons(exact, [f for f in files if _same(f) in doubtful]) if doubtful else {}
    skipped += _listed(entries, files, {f: bad[_same(f)] for f in files if _same(f) in bad}, missing,
                       set(known))
    good: dict[str, list[str]] = {}
    for f in files:
        column = known.get(_same(f))
        if column and _same(f) not in bad:
            good.setdefault(column, []).append(_as_path(f))
    return good


def _listed(entries: list[str], files: list[str], bad: dict[str, str], missing: dict[str, str],
            footers: set[str]) -> list[tuple[str, str]]:
    """(path, reason) in the order of the manifest's entries; an entry without
    any file that has a footer by its own path."""
    at = {urlsplit(p).path.rstrip("/"): p for p in entries}
    owned: dict[str, list[str]] = {}
    for f in files:
        path = unquote(urlsplit(f).path)
        while path and path not in at:
            path = path.rpartition("/")[0]
        owned.setdefault(at.get(path, f), []).append(f)
    out = []
    for p in dict.fromkeys([*entries, *owned]):
        found = [f for f in owned.get(p, ()) if f in bad]
        if p in missing:
            out.append((p, missing[p]))
        elif found and len(found) == len(owned[p]) and not any(_same(f) in footers for f in found):
            out.append((p, bad[found[0]]))
        else:
            out += [(unquote(f), bad[f]) for f in found]
    return out


def _reasons(exact: SparkSession, files: list[str]) -> dict[str, str]:
    """Why files cannot be read, of those that cannot."""
    binary = exact.read.format("binaryFile").load([_as_path(f) for f in files])
    sizes = {_same(r["path"]): r["length"] for r in binary.select("path", "length").collect()}
    # Spark passes over files without bytes.
    found = {_same(f): "empty file" for f in files if not sizes.get(_same(f))}
    whole = [f for f in files if 0 < sizes.get(_same(f), 0) <= CHECK_BYTES]
    if whole:
        small = exact.read.format("binaryFile").load([_as_path(f) for f in whole]).select("path", "content")
        checked = small.mapInArrow(_decode, "path string, reason string").where("reason <> ''")
        found |= {_same(r["path"]): r["reason"] for r in checked.collect()}
    for f in (f for f in files if sizes.get(_same(f), 0) > CHECK_BYTES):
        # Too large to hand over: what Spark itself says of it.
        try:
            _column_scan(exact, [_as_path(f)], URL_COLUMNS[0]).agg(F.max(F.length("url"))).collect()
        except (PySparkException, Py4JJavaError) as e:
            if not (reason := _bad_page(_causes(e))):
                raise
            found[_same(f)] = reason
    return found


def read_index(spark: SparkSession, paths: list[str], limit_rows: int | None = None,
               tolerant: bool = False, skipped: list[tuple[str, str]] | None = None) -> DataFrame:
    """(file_path, row_index, url) for all index files.

    Files are grouped by their URL column name (``url_columns``) and each group
    is read with one scan selecting just that column (usually one group).
    ``limit_rows`` keeps the first N rows of each file (before null-drop and
    dedup, as the source does).
    With ``tolerant`` a missing or corrupt file (also one in a folder, or one with
    a bad page) yields no rows; its path and the reason are added to ``skipped``.
    Such files are found before the scan, which passes over no error itself.
    """
    skipped = [] if skipped is None else skipped
    out = spark.createDataFrame([], "file_path string, row_index bigint, url string")
    if not paths:
        return out
    exact = _exact_session(spark)
    groups = _good_files(exact, paths, skipped) if tolerant else _by_column(exact, paths)
    for col, group in groups.items():
        df = _column_scan(exact, group, col)
        if limit_rows and limit_rows > 0:
            df = df.filter(F.col("row_index") < limit_rows)
        out = out.unionByName(df)
    return out


def index_label(file_path) -> "F.Column":
    """Short file label: ``x.parquet`` (a file), or ``x.parquet/k=v`` for a
    part file inside a (partitioned) ``x.parquet`` folder."""
    parent = F.regexp_extract(file_path, r"([^/]+[.]parquet(?:/[^/]+=[^/]+)*)/[^/]+$", 1)
    base = F.regexp_extract(file_path, r"([^/]+)$", 1)
    return F.when(parent != "", parent).otherwise(base)


def local_table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
