"""Landed API payloads as flat bronze rows.

A payload is one JSON document: one per line by default, or one per file with
``per="file"``. Every reader parses the document once with a fixed schema and
flattens it with ``inline``, so the work is spread over documents. With
``per="file"`` a whole file is one row, which suits payloads of an API call, not
files of many gigabytes.

A document that is no JSON, is ``null`` or not of its payload's shape, fails the read: a load
must not take what is left for the whole. ``broken="skip"`` leaves such documents
out, and :func:`bad_documents` lists them for a quarantine. Blank lines are no documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import first_present, safe_number, to_json_text
from ..functions.time import from_epoch, from_epoch_or_iso, parse_iso
from ..functions.units import uv_from_radiation
from ..operators.filters import before_cutoff, with_time
from ..schemas import (
    PRICE_CURRENCY,
    UNKNOWN_CONDITION,
    WEATHER_ENTITY,
    WEATHER_MEASURES,
)

# Attribute names of the weather entity, by bronze column.
WEATHER_ATTRIBUTES = {
    "temperature_C": "temperature",
    "pressure_hPa": "pressure",
    "humidity_percent": "humidity",
    "wind_speed_kmh": "wind_speed",
    "wind_bearing_deg": "wind_bearing",
    "cloud_coverage_pct": "cloud_coverage",
    "dew_point_C": "dew_point",
    "uv_index": "uv_index",
    "wind_gust_speed_kmh": "wind_gust_speed",
}

# Hourly array names of the archive service, by bronze column.
HOURLY_ARRAYS = {
    "temperature_C": "temperature_2m",
    "pressure_hPa": "surface_pressure",
    "humidity_percent": "relative_humidity_2m",
    "wind_speed_kmh": "wind_speed_10m",
    "wind_bearing_deg": "wind_direction_10m",
    "cloud_coverage_pct": "cloud_cover",
    "dew_point_C": "dew_point_2m",
    "uv_index": "shortwave_radiation",
    "wind_gust_speed_kmh": "wind_gusts_10m",
}

# Fields of a long-term statistics record.
STATISTIC_FIELDS = ["mean", "min", "max", "sum", "state"]
STATISTIC_SOURCE = "long_term_statistics"


def read_documents(spark: SparkSession, path: str, per: str = "line") -> DataFrame:
    """JSON documents as one text column ``value``."""
    if per not in ("line", "file"):
        raise ValueError("per must be 'line' or 'file'")
    return spark.read.text(path, wholetext=per == "file")


def _parse(documents: DataFrame, schema: str) -> DataFrame:
    """``value``, the parsed ``payload``, and ``is_broken`` where that was not possible."""
    wrapped = F.concat(F.lit('{"payload":'), F.col("value"), F.lit("}"))
    options = {"columnNameOfCorruptRecord": "unparsed"}
    parsed = F.from_json(wrapped, f"struct<payload:{schema},unparsed:string>", options)
    # what closes the wrapper itself, or adds a field to it, is not one element of a list
    alone = F.coalesce(F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]"))), F.lit(0)) == 1
    rows = documents.filter(F.trim("value") != "").select("value", parsed.alias("parsed"), alone.alias("is_alone"))
    broken = F.col("parsed.unparsed").isNotNull() | F.col("parsed.payload").isNull() | ~F.col("is_alone")
    return rows.select("value", F.col("parsed.payload").alias("payload"), broken.alias("is_broken"))


def _without_zone(parsed: DataFrame, zone: str) -> DataFrame:
    """Also takes successful price documents that have data but no list of the zone for broken.

    Their other fields are looked up only where the list is absent.
    """
    fields = F.json_object_keys(F.get_json_object("value", "$.data"))
    lost = F.col(f"payload.data.{zone}").isNull() & F.when(F.col("payload.data").isNotNull(), F.size(fields) > 0)
    broken = F.col("is_broken") | F.coalesce(F.col("payload.success") & lost, F.lit(False))
    return parsed.withColumn("is_broken", broken)


def _payloads(parsed: DataFrame, broken: str) -> DataFrame:
    """Parsed documents as one column ``payload``."""
    if broken not in ("fail", "skip"):
        raise ValueError("broken must be 'fail' or 'skip'")
    if broken == "skip":
        return parsed.filter("NOT is_broken").select("payload")
    message = F.concat(F.lit("broken document: "), F.substring("value", 1, 100))
    return parsed.select(F.when(F.col("is_broken"), F.raise_error(message)).otherwise(F.col("payload")).alias("payload"))


def parse_documents(documents: DataFrame, kind: str, *, zone: str = "ee") -> DataFrame:
    """``value, payload, is_broken`` of each text that is not blank; ``kind`` is ``history``,
    ``weather``, ``price``, ``statistics`` or ``hourly``. Works on streams as on batches."""
    schemas = {
        "history": _history_schema("string"),
        "weather": _history_schema(_attributes_type()),
        "price": _price_schema(zone),
        "statistics": _statistics_schema(),
        "hourly": _hourly_schema(),
    }
    parsed = _parse(documents, schemas[kind])
    return _without_zone(parsed, zone) if kind == "price" else parsed


def payload_rows(payloads: DataFrame, kind: str, *, zone: str = "ee", ingested_at: Column | None = None) -> DataFrame:
    """Bronze rows of parsed documents (column ``payload``, none of them broken)."""
    if kind == "price":
        return _price_rows(payloads, zone, ingested_at)
    rows = {"history": _iot_rows, "weather": _weather_rows, "statistics": _statistics_rows, "hourly": _hourly_rows}
    return rows[kind](payloads, ingested_at)


def _read(spark: SparkSession, path: str, kind: str, per: str, broken: str, zone: str = "ee") -> DataFrame:
    return _payloads(parse_documents(read_documents(spark, path, per), kind, zone=zone), broken)


def bad_documents(spark: SparkSession, path: str, kind: str, *, per: str = "line", zone: str = "ee") -> DataFrame:
    """Texts that a reader would refuse; kinds as in :func:`parse_documents`."""
    return parse_documents(read_documents(spark, path, per), kind, zone=zone).filter("is_broken").select("value")


def _ingested(at: Column | None) -> Column:
    return (F.current_timestamp() if at is None else at).alias("ingestion_ts")


def _history_schema(attributes_type: str) -> str:
    record = f"entity_id:string,state:string,last_changed:string,attributes:{attributes_type}"
    return f"array<array<struct<{record}>>>"


def _attributes_type() -> str:
    return f"struct<{','.join(f'{name}:string' for name in WEATHER_ATTRIBUTES.values())}>"


def _price_schema(zone: str) -> str:
    return f"struct<success:boolean,data:struct<{zone}:array<struct<timestamp:bigint,price:double>>>>"


def _statistics_schema() -> str:
    record = "start:string," + ",".join(f"{name}:string" for name in STATISTIC_FIELDS)
    return f"map<string,array<struct<{record}>>>"


def _hourly_schema() -> str:
    arrays = ",".join(f"{name}:array<double>" for name in HOURLY_ARRAYS.values())
    return f"struct<hourly:struct<time:array<string>,{arrays}>>"


def _history_records(payloads: DataFrame) -> DataFrame:
    return payloads.select(F.inline(F.flatten(F.filter("payload", lambda one: one.isNotNull()))))


def _iot_rows(payloads: DataFrame, ingested_at: Column | None) -> DataFrame:
    return _history_records(payloads).select(
        _ingested(ingested_at),
        "entity_id",
        "state",
        parse_iso(F.col("last_changed")).alias("last_changed"),
        F.coalesce("attributes", F.lit("{}")).alias("attributes"),
    )


def _weather_rows(payloads: DataFrame, ingested_at: Column | None) -> DataFrame:
    return _history_records(payloads).select(
        _ingested(ingested_at),
        "entity_id",
        F.col("state").alias("condition_state"),
        parse_iso(F.col("last_changed")).alias("last_changed"),
        *[
            safe_number(F.trim(F.col("attributes")[attribute])).alias(name)
            for name, attribute in WEATHER_ATTRIBUTES.items()
        ],
    )


def _price_rows(payloads: DataFrame, zone: str, ingested_at: Column | None) -> DataFrame:
    records = payloads.filter("payload.success").select(F.inline(f"payload.data.{zone}"))
    return records.select(
        _ingested(ingested_at),
        from_epoch(F.col("timestamp")).alias("ts_utc"),
        F.lit(zone.upper()).alias("zone"),
        F.lit(PRICE_CURRENCY).alias("currency"),
        F.col("price").alias("price_per_mwh"),
    )


def _statistics_rows(payloads: DataFrame, ingested_at: Column | None) -> DataFrame:
    by_entity = payloads.select(F.explode("payload").alias("entity_id", "records"))
    records = by_entity.select("entity_id", F.inline("records"))
    attributes = F.struct(
        *[safe_number(F.col(name)).alias(name) for name in STATISTIC_FIELDS],
        F.lit(STATISTIC_SOURCE).alias("source"),
    )
    rows = records.select(
        _ingested(ingested_at),
        "entity_id",
        first_present(F.col("mean"), F.col("state"), F.lit("")).alias("state"),
        from_epoch_or_iso(F.col("start")).alias("last_changed"),
        to_json_text(attributes).alias("attributes"),
    )
    return with_time(rows, "last_changed")


def _hourly_rows(payloads: DataFrame, ingested_at: Column | None) -> DataFrame:
    # a missing array would make the whole zip NULL, so an empty one stands in
    measures = [
        F.coalesce(F.col(f"payload.hourly.{name}"), F.array().cast("array<double>"))
        for name in HOURLY_ARRAYS.values()
    ]
    zipped = F.arrays_zip(F.col("payload.hourly.time"), *measures)
    hours = payloads.select(F.inline(zipped)).toDF("time", *HOURLY_ARRAYS.values())
    rows = hours.select(
        _ingested(ingested_at),
        F.lit(WEATHER_ENTITY).alias("entity_id"),
        F.lit(UNKNOWN_CONDITION).alias("condition_state"),
        parse_iso(F.col("time")).alias("last_changed"),
        *[
            (uv_from_radiation(F.col(source)) if name == "uv_index" else F.col(source)).alias(name)
            for name, source in HOURLY_ARRAYS.items()
        ],
    )
    return with_time(rows, "last_changed")


def read_iot_history(
    spark: SparkSession, path: str, *, per: str = "line", ingested_at: Column | None = None, broken: str = "fail"
) -> DataFrame:
    """History payload: a list of per-entity lists of state changes."""
    return _iot_rows(_read(spark, path, "history", per, broken), ingested_at)


def read_weather_history(
    spark: SparkSession, path: str, *, per: str = "line", ingested_at: Column | None = None, broken: str = "fail"
) -> DataFrame:
    """History payload of the weather entity, nine attributes as doubles."""
    return _weather_rows(_read(spark, path, "weather", per, broken), ingested_at)


def read_price(
    spark: SparkSession,
    path: str,
    *,
    per: str = "line",
    zone: str = "ee",
    ingested_at: Column | None = None,
    broken: str = "fail",
) -> DataFrame:
    """Price payload; unsuccessful documents and those without data give no rows, those
    whose data lacks the list of the zone are broken."""
    return _price_rows(_read(spark, path, "price", per, broken, zone), zone, ingested_at)


def read_statistics(
    spark: SparkSession, path: str, *, per: str = "line", ingested_at: Column | None = None, broken: str = "fail"
) -> DataFrame:
    """Long-term statistics keyed by entity; rows without a time are dropped."""
    return _statistics_rows(_read(spark, path, "statistics", per, broken), ingested_at)


def read_hourly_weather(
    spark: SparkSession,
    path: str,
    cutoff: Column,
    *,
    per: str = "line",
    ingested_at: Column | None = None,
    broken: str = "fail",
) -> DataFrame:
    """Parallel hourly arrays zipped by position; hours from ``cutoff`` on are dropped."""
    return before_cutoff(_hourly_rows(_read(spark, path, "hourly", per, broken), ingested_at), "last_changed", cutoff)


assert list(WEATHER_ATTRIBUTES) == WEATHER_MEASURES == list(HOURLY_ARRAYS)
