"""Schemas of the pipeline's tables and of the relational store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KINDS = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(), "doubles": T.ArrayType(T.DoubleType()), "strings": T.ArrayType(T.StringType())}


def _schema(spec: str) -> T.StructType:
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _KINDS[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


_SHEET = "nzgd_id int, file_name string, sheet_name string"
PIPELINE = {
    "cells": _schema(f"{_SHEET}, row int, col int, raw string, num double"),
    "measurements": _schema(f"{_SHEET}, seq int, Depth double, qc double, fs double, u double, explicit_unit_conversions string, inferred_unit_conversions string, removed_duplicates string, investigation_number int"),
    "failures": _schema("record_name string, file_name string, sheet_name string, category string, details string, failed_extraction_index int"),
    "candidates": _schema(f"ord long, {_SHEET}, likely_orientation string, search_term string, search_assumption string, assumed_orientation string, field_label string, value string"),
    "scalars": _schema(f"{_SHEET}, termination_reason string, ground_water_level double, gwl_method string, tip_net_area_ratio double"),
    "spt": _schema("borehole_id int, nzgd_id int, efficiency double, extracted_gwl double, source_file string"),
    "spt_meas": _schema("borehole_id int, depth double, n int"),
    "soil_meas": _schema("borehole_id int, top_depth double, soil_types strings"),
    "boxes": _schema("report string!, page int!, y0 double!, y1 double!, x0 double!, x1 double!, text string"),
}

_DIMENSION = "id int!, value string!"
STORE = {
    **{n: _schema(_DIMENSION) for n in (
        "type", "region", "district", "city", "suburb", "cpttovscorrelation", "spttovscorrelation", "vstovs30correlation",
        "spttovs30hammertype", "terminationreason", "cptgroundwaterlevelmethod",
    )},
    "soiltypes": _schema("id int!, name string!"),
    "nzgdrecord": _schema(
        "nzgd_id int!, type_id int!, latitude double, longitude double, model_vs30_foster_2019 double, model_vs30_stddev_foster_2019 double, "
        "model_gwl_westerhoff_2018 double, original_investigation_name string, investigation_date date, published_date date, region_id int, district_id int, city_id int, suburb_id int"
    ),
    "sptreport": _schema("borehole_id int!, nzgd_id int!, efficiency double, extracted_gwl double, gwl_residual double, source_file string"),
    "soilmeasurements": _schema("measurement_id long!, report_id int!, top_depth double!"),
    "soilmeasurementsoiltype": _schema("soil_measurement_id long!, soil_type_id int!"),
    "sptmeasurements": _schema("measurement_id long!, borehole_id int!, depth double!, n int!"),
    "cptreport": _schema(
        "cpt_id long!, nzgd_id int!, max_depth double, min_depth double, extracted_gwl double, gwl_method_id int, gwl_residual double, tip_net_area_ratio double, termination_reason_id int, "
        "has_cpt_data int!, cpt_data_duplicate_of_cpt_id long, did_explicit_unit_conversion int, did_inferred_unit_conversion int, source_file string"
    ),
    "cptmeasurements": _schema("measurement_id long!, cpt_id long!, depth double, qc double, fs double, u2 double"),
    "cptvs30estimates": _schema("vs30_id long!, cpt_id long!, nzgd_id int!, cpt_to_vs_correlation_id int!, vs_to_vs30_correlation_id int!, vs30 double, vs30_stddev double"),
    "sptvs30estimates": _schema(
        "vs30_id long!, spt_id int!, spt_to_vs_correlation_id int!, vs_to_vs30_correlation_id int!, borehole_diameter double, hammer_type_id int!, vs30_used_efficiency int, vs30_used_soil_info int, "
        "vs30 double, vs30_stddev double"
    ),
}
#: Primary keys of the store's tables; ``id`` where a table is not named.
KEYS = {
    "nzgdrecord": ["nzgd_id"], "sptreport": ["borehole_id"], "soilmeasurements": ["measurement_id"], "soilmeasurementsoiltype": ["soil_measurement_id", "soil_type_id"],
    "sptmeasurements": ["measurement_id"], "cptreport": ["cpt_id"], "cptmeasurements": ["measurement_id"], "cptvs30estimates": ["vs30_id"], "sptvs30estimates": ["vs30_id"],
}


def create_store(spark: SparkSession, path: str) -> None:
    """Write every table of the store that does not exist yet, empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name, schema in STORE.items():
        where = hadoop.Path(f"{path}/{name}")
        if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            spark.createDataFrame([], schema).write.parquet(f"{path}/{name}")


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a store table in order and type; missing ones are null, others dropped."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in STORE[name].fields])
