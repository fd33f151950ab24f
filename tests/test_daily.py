"""The daily job end to end on region files written from the listing view."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hausprep.plans.daily import daily_run
from hausprep.plans.listings import clean_listings
from hausprep.registry.fixtures import VIEW_COLUMNS, VIEW_OUTPUT, listing_view
from hausprep.session import scratch_path
from hausprep.sources import fs
from hausprep.sources.files import CSV_OPTIONS, read_csv_text
from hausprep.vocabularies import REGION_CODES


def test_daily_run(spark):
    v = listing_view(spark, SF_SMALL)
    code = F.element_at(F.array(*[F.lit(c) for c in REGION_CODES]), (F.col("listing_id") % 11 + 1).cast("int"))
    staging, landing = scratch_path(spark, "daily_staging"), scratch_path(spark, "daily_landing")
    v.withColumn("__file", F.concat(F.lit("data_"), code, F.lit(".csv"))).write.partitionBy("__file") \
        .options(**CSV_OPTIONS).csv(staging)
    for c in REGION_CODES[:-1]:                      # the last region's file is missing today
        fs.rename(spark, f"{staging}/__file=data_{c}.csv", f"{landing}/data_{c}.csv")

    report = daily_run(spark, landing, scratch_path(spark, "daily_out"), cols=VIEW_COLUMNS,
                       out=VIEW_OUTPUT, date=dt.date(2024, 5, 6))

    assert report["output"].endswith("cleaned_canada_20240506.csv")
    assert len(report["missing_files"]) == 1 and report["missing_files"][0].endswith("data_yt.csv")
    present = v.where(code != F.lit(REGION_CODES[-1]))
    assert report["rows_raw"] == present.count()
    expected = clean_listings(present, VIEW_COLUMNS, VIEW_OUTPUT).count()
    assert report["rows_final"] == expected
    assert read_csv_text(spark, report["output"]).count() == expected
    assert all(report["quality"][f"nulls_{c}"] == 0 for c in ["price", "bedrooms", "bathrooms", "square_footage"])
    assert report["null_counts"]["price"] == 0
