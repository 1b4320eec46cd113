"""Landing: reading delivered files into raw tables, and the raw sinks.

S01-S03 gzip CSV per (department, year) with lineage from the file path,
S04/S05 delimiter and encoding detection per file in one scan, S07 parquet, S08/S09 wide bars to
long rows, S11 header names, S12 load stamp, S13/S14 append / replace
sinks, S15 rows-written count from an observation (no second scan).
"""

from __future__ import annotations

import csv
import functools
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from cadastra.functions.names import normalize_column_name, normalize_columns
from cadastra.operators.materialize import materialize
from cadastra.sources.files import first_lines, list_files

# Candidate delimiters in the order tried, and encodings.
DELIMITERS = (";", ",")
ENCODINGS = ("utf-8", "iso-8859-1")  # iso-8859-1 is latin-1


_LAYOUTS = {  # path pattern, year and department in it
    "files": ("/*/*.csv.gz", r"/(\d{4})/[^/]+\.csv\.gz$", r"/([^/]+)\.csv\.gz$"),
    "hive": ("/*/*/*.csv.gz", r"/year=(\d{4})/", r"/dep=([^/]+)/"),
}


def _layout(layout: str) -> tuple[str, str, str]:
    if layout not in _LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    return _LAYOUTS[layout]


def delivered_files(spark: SparkSession, root: str, layout: str = "files") -> dict[str, tuple[str, int] | None]:
    """Every delivered sales file with its (department, year); None where the path does not name a pair."""
    glob, year_re, dep_re = _layout(layout)
    out = {}
    for f in list_files(spark, root + glob):
        year, dep = re.search(year_re, f), re.search(dep_re, f)
        out[f] = (dep.group(1), int(year.group(1))) if year and dep else None
    return out


def read_sales_csv(spark: SparkSession, root: str, layout: str = "files", files: Sequence[str] | None = None) -> DataFrame:
    """Every delivered sales file under ``root`` as all-string rows.

    ``layout="files"``: ``<root>/<year>/<department>.csv.gz`` (one file per
    pair, as downloaded); ``layout="hive"``: ``<root>/year=<y>/dep=<d>/*.csv.gz``
    (as Spark writes them). Lineage comes from each row's own file path, so
    one scan covers every pair. gzip is not splittable (one task per file):
    callers repartition before heavy work. Every file is read by its own
    header: only first lines are read for that, files are grouped by them, and
    the groups are united by column name. A missing file is simply not matched,
    an empty file yields no rows, and with nothing landed there are no rows
    (lineage columns only). ``files`` restricts the read to some of them.
    """
    _, year_re, dep_re = _layout(layout)
    path = F.col("_metadata.file_path")
    by_header: dict[bytes, list[str]] = {}
    files = delivered_files(spark, root, layout) if files is None else files
    for f, header in sorted(first_lines(spark, list(files)).items()):
        by_header.setdefault(header.rstrip(b"\r"), []).append(f)
    if not by_header:
        return spark.createDataFrame([], "source_departement string, source_year int")
    groups = [
        spark.read.schema(_text_columns(header)).option("header", True).csv(same).select(
            "*",
            F.regexp_extract(path, dep_re, 1).alias("source_departement"),
            F.regexp_extract(path, year_re, 1).cast("int").alias("source_year"),
        )
        for header, same in by_header.items()
    ]
    return union_frames(groups)


def _text_columns(header: bytes) -> T.StructType:
    names = next(csv.reader([header.decode(ENCODINGS[0], "replace")]))
    return T.StructType([T.StructField(normalize_column_name(n), T.StringType()) for n in names])


def _decode(line: bytes) -> str:
    try:
        return line.decode(ENCODINGS[0])
    except UnicodeDecodeError:
        return line.decode(ENCODINGS[1])


def header_delimiter(header: str) -> str:
    """The first candidate that splits a header into more than one column."""
    for sep in DELIMITERS:
        if len(next(csv.reader([header], delimiter=sep), [])) > 1:
            return sep
    raise ValueError(f"no delimiter among {DELIMITERS!r} splits the header {header!r}")


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """S04 for a file: the delimiter of its header."""
    lines = first_lines(spark, list_files(spark, path))
    if not lines:
        raise ValueError(f"no header in {path}")
    return header_delimiter(_decode(lines[min(lines)]))


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """All-string CSV files, delimiter detected per file, each file utf-8 or else latin-1.

    The files are scanned once, as latin-1, which keeps every byte as one
    character. The rows are written with the bytes as they came; a file is
    utf-8 if all its values are, which one aggregate over the written flags
    tells (a row per file), and its values are then decoded on read. Header
    lines are decoded file by file; files with equal columns are one scan.
    """
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    latin_header: dict[str, bool] = {}
    for f, line in sorted(first_lines(spark, list_files(spark, path)).items()):
        header = _decode(line.rstrip(b"\r"))
        sep = header_delimiter(header)
        names = tuple(normalize_column_name(c) for c in next(csv.reader([header], delimiter=sep)))
        groups.setdefault((sep, names), []).append(f)
        latin_header[f] = header.encode(ENCODINGS[0]) != line.rstrip(b"\r")
    if not groups:
        raise ValueError(f"no header in {path}")
    frames = []
    for (sep, names), same in groups.items():
        slots = [f"c{i}" for i in range(len(names))]  # two headers may fold to one name
        rows = spark.read.schema(", ".join(f"{c} string" for c in slots)).option("header", True).option(
            "sep", sep).option("encoding", ENCODINGS[1]).csv(same)
        frames.append((slots, names, rows.select(F.col("_metadata.file_path").alias("_file"), *slots)))
    out = []
    for slots, names, rows in frames:
        raw = {c: F.encode(F.col(c), ENCODINGS[1]) for c in slots}
        ok = [F.coalesce(F.is_valid_utf8(raw[c].cast("string")), F.lit(True)) for c in slots]
        kept = materialize(rows.withColumn("_utf8", functools.reduce(lambda a, b: a & b, ok)))
        files = kept.groupBy("_file").agg(F.every("_utf8").alias("_all"))
        latin = [f for f, is_latin in latin_header.items() if is_latin]  # a row per file, as the header lines
        files = files.select("_file", (F.col("_all") & ~F.col("_file").isin(latin)).alias("_all"))
        told = kept.join(F.broadcast(files), "_file")  # a row per file
        out.append(told.select(*[
            F.when(F.col("_all"), F.decode(raw[c], ENCODINGS[0])).otherwise(F.col(c)).alias(n)
            for c, n in zip(slots, names)]))
    return union_frames(out)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet reference table, headers normalised."""
    return normalize_columns(spark.read.parquet(path))


def wide_to_long(wide: DataFrame, date_col: str, fields: Sequence[str], tickers: Sequence[str],
                 sep: str = "|") -> DataFrame:
    """``<field><sep><ticker>`` columns to one row per (ticker, date).

    Every source row gives one row per ticker, by exploding one struct per
    ticker: no shuffle, and two source rows of one date stay two bars. Rows
    with every field null or NaN drop. A field a ticker lacks is null.
    """
    def value(field: str, ticker: str):
        name = f"{field}{sep}{ticker}"
        if name not in wide.columns:
            return F.lit(None).cast("double").alias(field)
        v = F.col(f"`{name}`").cast("double")
        return F.when(~F.isnan(v), v).alias(field)

    held = [t for t in tickers if any(f"{f}{sep}{t}" in wide.columns for f in fields)]
    if not held:
        return wide.select(F.lit(None).cast("string").alias("ticker"), F.col(date_col),
                           *[F.lit(None).cast("double").alias(f) for f in fields]).where(F.lit(False))
    bars = F.array(*[F.struct(F.lit(t).alias("ticker"), *[value(f, t) for f in fields]) for t in held])
    out = wide.select(F.col(date_col), F.explode(bars).alias("_bar")).select(
        "_bar.ticker", date_col, *[f"_bar.{f}" for f in fields])
    return out.dropna(how="all", subset=list(fields))


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name (missing columns become null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stamp(df: DataFrame, batch_ts: datetime) -> DataFrame:
    """One ``_ingested_at`` value for the whole load (passed in, repeatable)."""
    return df.withColumn("_ingested_at", F.lit(batch_ts).cast("timestamp"))


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), only_delivered: bool = False) -> int:
    obs = Observation(f"rows_{mode}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if only_delivered else "static")
    w.parquet(path)
    return int(obs.get["rows"])


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append to an event-like raw table; returns rows written."""
    return _write(df, path, "append", partition_by)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), only_delivered: bool = False) -> int:
    """Replace a reference raw table; returns rows written.

    ``only_delivered``: replace the partitions that ``df`` holds, keep the others.
    """
    return _write(df, path, "overwrite", partition_by, only_delivered)
