"""The daily listing job as one driver program: region files -> clean
listings -> dated CSV, with the quality checks and run metrics.

S1 (missing regions recorded) -> P1 -> one materialised clean table ->
W1 written from it -> P6 quality report, A6 null counts and row metrics
read from the same table.  The cleaner runs once; every report is a small
aggregate.  Warnings are values in the returned report, never a reason to
skip the save.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hausprep.operators.profile import null_counts
from hausprep.plans.listings import ListingColumns, ListingOutput, clean_listings
from hausprep.plans.quality import quality_report
from hausprep.session import materialize, materialize_observed, scratch_scope
from hausprep.sinks.files import write_csv_dated
from hausprep.sources.files import scan_regions
from hausprep.vocabularies import REGION_CODES


def daily_run(
    spark: SparkSession,
    landing_dir: str,
    out_dir: str,
    *,
    codes: Sequence[str] = REGION_CODES,
    cols: ListingColumns = ListingColumns(),
    out: ListingOutput = ListingOutput(),
    date: _dt.date | None = None,
    prefix: str = "cleaned_canada",
    multi_line: bool = True,
) -> dict:
    """Run the daily job; return a report with the output path, missing
    region files, rows per region, final rows, null counts and the quality
    report (all small values).  Intermediate tables are deleted at the end, also
    after a failure."""
    with scratch_scope(spark):
        return _daily(spark, landing_dir, out_dir, codes, cols, out, date, prefix, multi_line)


def _daily(spark, landing_dir, out_dir, codes, cols, out, date, prefix, multi_line) -> dict:
    scan = scan_regions(spark, landing_dir, codes, multi_line=multi_line)
    # The files are parsed once; rows per region are counted in the same write.
    regions = [F.count_if(F.col("source") == code).alias(code) for code in codes]
    raw, counted = materialize_observed(scan.frame, regions, "daily_raw")
    raw_rows = {code: n for code, n in counted.items() if n}
    raw = raw.drop("source")
    cleaned = materialize(clean_listings(raw, cols, out), "daily_clean")
    path = write_csv_dated(cleaned, out_dir, prefix=prefix, date=date)
    critical = [out.price, out.bedrooms, out.bathrooms, out.square_footage]
    quality = quality_report(cleaned, critical, out.price).first().asDict()
    nulls = {r["column_name"]: r["nulls"] for r in null_counts(cleaned).collect()}
    final_rows = cleaned.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return {
        "output": path,
        "missing_files": scan.missing,
        "rows_per_region": raw_rows,
        "rows_raw": sum(raw_rows.values()),
        "rows_final": final_rows,
        "null_counts": nulls,
        "quality": quality,
        "warnings": bool(quality["warning"]),
    }
