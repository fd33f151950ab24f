"""File sources (S1-S4, S8) and CSV header handling.

CSV files are read **all text**: no type inference at read time, so files
whose columns disagree in type can still be unioned by name; types are set
later, explicitly (F6) or by inference (C3).  Quoting follows RFC 4180
(``"`` doubled inside quoted cells), the dialect spreadsheet tools and
pandas write.

Records are found by :mod:`hausprep.sources.records`, over many tasks also where
cells hold line breaks, and parsed by ``from_csv``.  Files with the same header
are one scan, however many they are.  Files may be compressed, as their names tell; one
task then reads a whole file (but of ``.bz2``), so land large ones in many parts.

A record with more cells than the header names has no place for the last ones.
``malformed="raise"`` (the default) raises when such a record is read, whatever
columns are asked for; one with fewer cells is filled up with nulls, as pandas does.
``malformed="quarantine"`` takes both kinds out of the rows and returns them as they
stand in the file.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.schema import dedupe_column_names
from hausprep.operators.setops import union_by_name
from hausprep.sources import fs
from hausprep.sources.records import csv_records, ends_inside
from hausprep.vocabularies import CLEANED_FILE_MARKER, REGION_CODES

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"',
               # cells are kept byte for byte (Spark's writer trims by default)
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
HEADER_THREADS = 16
REJECTED = "source string, reason string, record string"


def csv_header(spark: SparkSession, path: str, *, multi_line: bool = True) -> list[str]:
    """Raw header names of a CSV file or of a Spark output directory (repeats kept)."""
    if path.rstrip("/").rsplit("/", 1)[-1].startswith("_"):
        raise ValueError(f"Spark reads no file whose name begins with '_': rename {path}")
    text = fs.first_lines(spark, path, lambda t: not (multi_line and ends_inside(t, False)))
    return next(csv.reader([text + "\n"], strict=False)) if text else []


@dataclass
class ScanResult:
    """A unioned frame plus what the scan found and skipped.

    ``rejected`` (``source, reason, record``) holds the malformed records if they are quarantined; ``counts`` is then
    an observation that an action on ``frame`` fills with ``records``, ``too_long`` and ``too_short``."""

    frame: DataFrame | None
    included: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    rejected: DataFrame | None = None
    counts: list[Observation] = field(default_factory=list)

    def malformed(self) -> dict[str, int]:
        """The counts, after an action on the frame."""
        found = [c.get for c in self.counts]
        return {k: sum(f[k] for f in found) for k in ("records", "too_long", "too_short")}


def _parsed(records: DataFrame, names: Sequence[str], source_column: str | None, malformed: str,
            ) -> tuple[DataFrame, DataFrame | None, Observation | None]:
    """Rows, rejected records and their counts, for records of one header."""
    cells, n = F.col("cells"), len(names)
    rejected = counts = None
    if malformed == "quarantine":
        counts = Observation()
        reason = F.when(cells > n, "too_long").when(cells < n, "too_short")
        rejected = records.where(cells != n).select("source", reason.alias("reason"), F.col("value").alias("record"))
        records = records.observe(counts, F.count(F.lit(1)).alias("records"), F.count_if(cells > n).alias("too_long"),
                                  F.count_if(cells < n).alias("too_short")).where(cells == n)
    elif malformed == "raise":
        message = F.concat(F.lit(f"a record has more than {n} cells, in "), "source", F.lit(": "), F.left("value", F.lit(200)))
        records = records.where(F.when(cells > n, F.raise_error(message)).otherwise(F.lit(True)))
    else:
        raise ValueError(f"unknown treatment of malformed records: {malformed!r}")
    schema = ", ".join(f"c{i} STRING" for i in range(n))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"multiLine": "true", "maxColumns": str(max(20480, n + 1))}
    parsed = records.select("source", F.from_csv("value", schema, options).alias("r"))
    columns = [F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)]
    if source_column:
        columns.append(F.col("source").alias(source_column))
    return parsed.select(*columns), rejected, counts


def _scan(spark: SparkSession, files: Sequence[tuple[str, str]], source_column: str | None, multi_line: bool, malformed: str,
          label: Callable[[Column], Column] | None = None) -> ScanResult:
    """One scan for each distinct header among ``(source, path)`` files; rows carry their source.

    A file's source is its name (or ``label`` over it); a Spark output directory's is the directory's name."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda f: tuple(dedupe_column_names(csv_header(spark, f[1], multi_line=multi_line))), files))
        sizes = list(pool.map(lambda f: fs.split_sizes(spark, f[1]), files))
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    never_split = min(as_bytes(spark.conf.get(f"spark.sql.files.{c}")) for c in ("openCostInBytes", "maxPartitionBytes"))
    groups: dict[tuple, list[int]] = {}
    for i, (_, path) in enumerate(files):
        if headers[i]:
            groups.setdefault((headers[i], fs.is_file(spark, path)), []).append(i)
    result = ScanResult(None, included=[p for _, p in files])
    frames, rejected = [], []
    for (names, is_file), members in groups.items():
        # The path is that of a URI, in which a plus sign stands for itself.
        name = F.element_at(F.split("_metadata.file_path", "/"), -1 if is_file else -2)
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        records = csv_records(spark, [files[i][1] for i in members], label(name) if label else name, quoted_breaks=multi_line,
                              split=any(size > never_split for i in members for size in sizes[i]))
        frame, bad, counts = _parsed(records, names, source_column, malformed)
        frames.append(frame)
        if bad is not None:
            rejected.append(bad)
            result.counts.append(counts)
    result.frame = union_by_name(frames) if frames else spark.createDataFrame([], T.StructType([]))
    if malformed == "quarantine":
        result.rejected = union_by_name(rejected) if rejected else spark.createDataFrame([], REJECTED)
    return result


def read_csv_text(spark: SparkSession, path: str, *, multi_line: bool = True, malformed: str = "raise") -> DataFrame:
    """Read one CSV file (or Spark output directory) with every column as
    text.  Repeated header names become ``name_1``, ``name_2`` ... (C2).

    ``multi_line`` keeps quoted line breaks inside a cell; a large file is read by
    many tasks either way.  A file name that begins with ``_`` raises: Spark would
    read it as empty.  Malformed records: see the module."""
    return _scan(spark, [("", path)], None, multi_line, malformed).frame


def scan_regions(
    spark: SparkSession,
    directory: str,
    codes: Sequence[str] = REGION_CODES,
    *,
    pattern: str = "data_{code}.csv",
    strict: bool = False,
    source_column: str = "source",
    multi_line: bool = True,
    malformed: str = "raise",
) -> ScanResult:
    """One CSV per region code; absent files are recorded and skipped
    (``strict=True``: an error); no file at all is always an error.  Each
    row carries its region code in ``source_column``.

    Region sizes may be very uneven (one region can hold a third of all
    rows): every file is split into as many tasks as its size asks for."""
    included, missing = [], []
    base = directory.rstrip("/")
    present = {name for name, _ in fs.list_names(spark, directory)} if fs.exists(spark, directory) else set()
    for code in codes:
        name = pattern.format(code=code)
        if name not in present:   # the folder is listed once
            if strict:
                raise FileNotFoundError(f"{base}/{name}")
            missing.append(f"{base}/{name}")
            continue
        included.append((name, f"{base}/{name}"))
    if not included:
        raise FileNotFoundError(f"no region files found in {directory}")
    code_of = F.create_map(*[F.lit(x) for code in codes for x in (pattern.format(code=code), code)])
    result = _scan(spark, included, source_column, multi_line, malformed, lambda name: code_of[name])
    result.missing = missing
    return result


def _csv_entries(spark: SparkSession, directory: str) -> list[tuple[str, str]]:
    return [(n, p) for n, p in fs.list_names(spark, directory) if n.lower().endswith(".csv")]


def scan_csv_files(spark: SparkSession, directory: str, *, source_column: str | None = "source",
                   multi_line: bool = True, malformed: str = "raise") -> ScanResult:
    """S2 with what is known of malformed records."""
    entries = _csv_entries(spark, directory)
    if not entries:
        raise FileNotFoundError(f"no csv files in {directory}")
    return _scan(spark, entries, source_column, multi_line, malformed)


def scan_csv_dir(spark: SparkSession, directory: str, *, source_column: str | None = "source",
                 multi_line: bool = True) -> DataFrame:
    """Every ``*.csv`` of a directory, unioned by name (each file keeps
    its own header, so column sets may differ; one scan per distinct header)."""
    return scan_csv_files(spark, directory, source_column=source_column, multi_line=multi_line).frame


def csv_names(spark: SparkSession, directory: str, marker: str) -> tuple[list[str], list[str]]:
    """Names of the CSV files of a directory: those without and those with ``marker``."""
    names = [n for n, _ in _csv_entries(spark, directory)]
    marked = [n for n in names if marker.lower() in n.lower()]
    return [n for n in names if n not in marked], marked


def scan_csv_excluding(spark: SparkSession, directory: str, marker: str = CLEANED_FILE_MARKER, *,
                       source_column: str | None = "source", multi_line: bool = True, malformed: str = "raise") -> ScanResult:
    """S3: like S2 but skipping files whose name contains ``marker``
    (case-insensitive).  An empty selection is not an error."""
    included, excluded = csv_names(spark, directory, marker)
    entries = [(n, f"{directory.rstrip('/')}/{n}") for n in included]
    result = _scan(spark, entries, source_column, multi_line, malformed) if entries else ScanResult(None)
    result.included, result.excluded = included, excluded
    return result


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet (filters and column pruning reach the scan)."""
    return spark.read.parquet(path)


class EmptyInput(Exception):
    """Raised by :func:`empty_guard` with ``policy="raise"``."""


def empty_guard(df: DataFrame, policy: str = "raise", name: str = "input") -> tuple[DataFrame | None, str]:
    """What to do with an empty frame.  Returns ``(frame or None, status)``
    with status ``ok``, ``skipped`` or ``stopped``; ``raise`` raises.
    ``isEmpty`` stops at the first row found."""
    if not df.isEmpty():
        return df, "ok"
    if policy == "raise":
        raise EmptyInput(f"{name} is empty")
    if policy == "skip":
        return None, "skipped"
    if policy == "stop":
        return None, "stopped"
    raise ValueError(f"unknown policy {policy!r}")
