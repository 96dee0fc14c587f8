"""Tables of record metadata from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXT = ["InvestigationId", "CreatedOn", "LastModifiedOn", "region", "district", "city", "suburb"]
_NUMBERS = ["Latitude", "Longitude", "model_vs30_foster_2019", "model_vs30_std_foster_2019", "model_gwl_westerhoff_2018"]


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata rows under the store's names: nzgd_id, latitude, longitude, the models, name, dates, places, and ``line``.

    Columns are found by name, in any order; missing ones are null and others ignored. A value that is no number or no date is null, and
    a row without an id is left out. ``line`` orders the rows of one id: file by file, as they are read.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    have = set(raw.columns)
    rows = raw.select(F.monotonically_increasing_id().alias("line"), *[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in ["nzgd_id", *_TEXT, *_NUMBERS]])
    day = lambda c: F.to_date(F.substring(F.regexp_extract(c, r"^\s*(\d{4}-\d{2}-\d{2})", 1), 1, 10).try_cast("date"))
    number = lambda c: F.trim(c).try_cast("double")
    return rows.select(
        F.trim("nzgd_id").try_cast("double").try_cast("int").alias("nzgd_id"), number("Latitude").alias("latitude"), number("Longitude").alias("longitude"),
        number("model_vs30_foster_2019").alias("model_vs30_foster_2019"), number("model_vs30_std_foster_2019").alias("model_vs30_stddev_foster_2019"),
        number("model_gwl_westerhoff_2018").alias("model_gwl_westerhoff_2018"), F.col("InvestigationId").alias("original_investigation_name"),
        day("CreatedOn").alias("investigation_date"), day("LastModifiedOn").alias("published_date"), "region", "district", "city", "suburb", "line",
    ).where("nzgd_id is not null")
