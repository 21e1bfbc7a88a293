"""Readers for trip, weather, zone and feature files."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.config import WEATHER_ATTRIBUTES
from tripmill.operators.star import POSITION

log = logging.getLogger(__name__)

LOOKUP_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
FEATURE_TYPE = (
    "struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
)
ORDER_TYPE = "struct<file:string,block:bigint,row:bigint>"
# Entries whose footers are read at a time when a folder holds several forms.
FOOTER_JOBS = 16


def read_trips(spark: SparkSession, directory: str, schema: str | None = None, positions: bool = False) -> DataFrame:
    """All ``*.parquet`` entries directly in a directory, united by column name.

    A column that a file lacks is null there. Where types disagree, entries of equal types are one scan, so
    that the union can widen them: as many scans as there are forms of entries, not as there are entries. With a ``schema`` no footer has to be read to plan the scan. ``positions`` adds
    the path of the file and the place of the row in it.
    """
    pattern = f"{directory.rstrip('/')}/*.parquet"
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    try:
        return _placed(reader.parquet(pattern), positions)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no .parquet files in {directory}") from error
        raise
    except Exception as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    frames = [_placed(frame, positions) for frame in _by_form(spark, _entries(spark, pattern))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _with_common_types(frames))


def _by_form(spark: SparkSession, entries: list[str]) -> list[DataFrame]:
    """One scan for all entries that have the same columns and types, in any order of columns. Spark reads
    the footers of an entry in tasks; several entries are looked at side by side."""

    def schema(entry: str) -> T.StructType:
        return spark.read.option("mergeSchema", True).parquet(entry).schema

    with ThreadPoolExecutor(FOOTER_JOBS) as pool:
        schemas = list(pool.map(schema, entries))
    alike: dict[tuple[str, ...], list[int]] = {}
    for number, found in enumerate(schemas):
        alike.setdefault(tuple(sorted(field.json() for field in found)), []).append(number)
    return [spark.read.schema(schemas[same[0]]).parquet(*[entries[n] for n in same]) for same in alike.values()]


def _placed(trips: DataFrame, positions: bool) -> DataFrame:
    if not positions:
        return trips
    place = (F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return trips.select("*", *[column.alias(name) for column, name in zip(place, POSITION)])


def _entries(spark: SparkSession, pattern: str) -> list[str]:
    """The monthly files or datasets, as the file system lists them: not the parts inside them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found)


def _with_common_types(frames: list[DataFrame]) -> list[DataFrame]:
    """Where one file has text and another numbers or times, text that is neither becomes null."""
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    target = {}
    for name, types in kinds.items():
        if len(set(types)) > 1 and any(isinstance(t, T.StringType) for t in types):
            others = [t for t in types if not isinstance(t, T.StringType)]
            if all(isinstance(t, T.NumericType) for t in others):
                target[name] = "double"
            elif all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in others):
                target[name] = "timestamp_ntz"
            else:
                target[name] = "string"
    return [
        frame.withColumns({c: F.col(f"`{c}`").try_cast(target[c]) for c in frame.columns if c in target}) if target else frame
        for frame in frames
    ]


def _position() -> dict[str, Column]:
    """Place of a row in its file: splits are ordered by offset, rows by reading order inside a split."""
    return {
        "file": F.col("_metadata.file_path"),
        "block_start": F.col("_metadata.file_block_start"),
        "row_in_block": F.monotonically_increasing_id(),
    }


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """Text columns by header; a quote inside quotes is doubled."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_weather(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Hourly weather CSVs in list order; missing files are skipped, none at all gives ``None``.

    Columns are matched by header name. The position columns let the first observation of an hour win.
    """
    frames = []
    for number, path in enumerate(paths):
        try:
            raw = _csv(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("weather file not found, skipped: %s", path)
            continue
        columns = [
            F.col(c).try_cast("double").alias(c) if c in WEATHER_ATTRIBUTES and c != "conditions" else F.col(f"`{c}`")
            for c in raw.columns
        ]
        position = [column.alias(name) for name, column in _position().items()]
        frames.append(raw.select(*columns, F.lit(number).alias("source_order"), *position))
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_zone_lookup(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """Zone names by id. Rows without id are dropped; of a repeated id the last row counts."""
    try:
        raw = _csv(spark, path)
    except AnalysisException as error:
        if on_error != "empty":
            raise
        log.warning("zone lookup not readable, taken as empty: %s", error)
        return spark.createDataFrame([], LOOKUP_SCHEMA)
    names = [c for c in ("Borough", "Zone", "service_zone") if c in raw.columns]
    placed = raw.select(F.col("LocationID").try_cast("double").cast("int").alias("LocationID"), *names,
                        *[column.alias(name) for name, column in _position().items()])
    last = F.max_by(F.struct(*names), F.struct("file", "block_start", "row_in_block")).alias("last")
    by_id = placed.filter("LocationID IS NOT NULL").groupBy("LocationID").agg(last)
    return by_id.select("LocationID", *[F.col(f"last.{c}") for c in names])


def read_features(spark: SparkSession, path: str, layout: str = "lines", on_error: str = "raise") -> DataFrame:
    """GeoJSON features as ``(feature_order, properties, geometry_type, coordinates)``.

    ``layout='lines'`` reads a collection with one feature per line, which splits over tasks;
    ``layout='document'`` reads one JSON document of any layout, which is one task by nature.
    """
    try:
        if layout == "document":
            document = spark.read.option("multiLine", True).schema(f"features array<{FEATURE_TYPE}>").json(path)
            order = F.struct(
                F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("block"),
                F.col("pos").cast("bigint").alias("row"),
            )
            rows = document.select("_metadata", F.posexplode("features").alias("pos", "feature")).select(
                order.alias("feature_order"), "feature"
            )
        else:
            line = F.regexp_replace("value", r"^\s*,|,\s*$", "")
            order = F.struct(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            )
            rows = (
                spark.read.text(path)
                .select(order.alias("feature_order"), F.from_json(line, FEATURE_TYPE).alias("feature"))
                .filter("feature.type = 'Feature'")
            )
    except AnalysisException as error:
        if on_error != "empty":
            raise
        log.warning("features not readable, taken as empty: %s", error)
        return spark.createDataFrame(
            [], f"feature_order {ORDER_TYPE}, properties map<string,string>, geometry_type string, coordinates string"
        )
    return rows.select(
        "feature_order",
        F.col("feature.properties").alias("properties"),
        F.col("feature.geometry.type").alias("geometry_type"),
        F.col("feature.geometry.coordinates").alias("coordinates"),
    )
