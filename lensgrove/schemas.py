"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T



_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BINARY": T.BinaryType()}


def _ddl(text: str) -> T.StructType:
    """Flat schemas from 'name TYPE, ...'; needs no session, unlike Spark's own parser."""
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in (x.split() for x in text.split(","))])


PHOTOS = _ddl("photo_uuid STRING, photo_id STRING, observation_uuid STRING, observer_id STRING, extension STRING, license STRING, width STRING, height STRING, position STRING")
OBSERVATIONS = _ddl("observation_uuid STRING, observer_id STRING, latitude STRING, longitude STRING, positional_accuracy STRING, taxon_id STRING, quality_grade STRING, observed_on STRING, anomaly_score STRING")
TAXA = _ddl("taxon_id STRING, ancestry STRING, rank_level STRING, rank STRING, name STRING, active STRING")
INDEX = _ddl("taxon_id INT, photo_id BIGINT, extension STRING, taxon_name STRING, quality_grade STRING, latitude FLOAT, longitude FLOAT")

API_PHOTO = _ddl("id BIGINT, uuid STRING, license_code STRING, attribution STRING, width INT, height INT, url STRING, original_url STRING")
API_OBSERVATION = T.StructType(
    [
        *_ddl("id BIGINT, uuid STRING, quality_grade STRING, observed_on STRING, time_observed_at STRING, created_at STRING, updated_at STRING").fields,
        *_ddl("license_code STRING, geoprivacy STRING, taxon_geoprivacy STRING, location STRING, latitude DOUBLE, longitude DOUBLE, place_guess STRING").fields,
        *_ddl("captive BOOLEAN, identifications_count BIGINT, comments_count BIGINT, faves_count BIGINT").fields,
        T.StructField("user", _ddl("id BIGINT, login STRING")),
        T.StructField("taxon", _ddl("id BIGINT, name STRING, preferred_common_name STRING, rank STRING, ancestry STRING")),
        T.StructField("photos", T.ArrayType(API_PHOTO)),
    ]
)

RGB = _ddl("r INT, g INT, b INT")
BOX = _ddl("x1 INT, y1 INT, x2 INT, y2 INT")
MASK = _ddl("h INT, w INT, data BINARY")
INSTANCE = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("n_pixels", T.LongType()),
        T.StructField("avg_rgb", RGB),
        T.StructField("bbox", BOX),
        T.StructField("mask", MASK),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("global_index", T.LongType()),
        T.StructField("batch_name", T.StringType()),
        T.StructField("image_relpath", T.StringType()),
        T.StructField("mask_batch_relpath", T.StringType()),
        T.StructField("overlay_relpath", T.StringType()),
        T.StructField("image_name", T.StringType()),
        T.StructField("taxon_id", T.IntegerType()),
        T.StructField("taxon_name", T.StringType()),
        T.StructField("observation_id", T.LongType()),
        T.StructField("photo_id", T.LongType()),
        T.StructField("image_index", T.LongType()),
        T.StructField("photo_url", T.StringType()),
        T.StructField("num_instances", T.IntegerType()),
        T.StructField("mask_files", T.ArrayType(T.StringType())),
        T.StructField("mask_scores", T.ArrayType(T.DoubleType())),
        T.StructField("avg_rgb", T.ArrayType(RGB)),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
    ]
)

CHECK = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
        T.StructField("traceback", T.StringType()),
    ]
)
CHECK_RUN = T.StructType(
    [
        T.StructField("started_at", T.DoubleType()),
        T.StructField("finished_at", T.DoubleType()),
        T.StructField("total_duration_sec", T.DoubleType()),
        T.StructField("args", T.MapType(T.StringType(), T.StringType())),
        T.StructField("results", T.ArrayType(CHECK)),
        T.StructField("all_ok", T.BooleanType()),
    ]
)
RECEIPT = _ddl("local_dir STRING, remote_share STRING, remote_subpath STRING, tar_path STRING, tar_bytes BIGINT, tar_duration_sec DOUBLE, put_duration_sec DOUBLE, remote_listing STRING")
KPI = _ddl("metric STRING, value DOUBLE")
