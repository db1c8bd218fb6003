"""The star schema over the feeds, built once per session and data folder.

The models are tables, as in production: questions read them, they are not
rebuilt for every question. ``bench.py`` times the build on its own.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hearth.plans.star import Star, build_star
from hearth.session import scratch_path

from . import feeds

_built: dict[tuple[str, str], Star] = {}


def build(spark: SparkSession, sf_dir: str) -> Star:
    return build_star(
        bronze_iot=feeds.readings(spark, sf_dir),
        bronze_weather=feeds.weather(spark, sf_dir),
        bronze_price=feeds.prices(spark, sf_dir),
        bronze_device=feeds.devices(spark, sf_dir),
        bronze_location=feeds.locations(spark, sf_dir),
        holidays=feeds.holidays(spark),
        root=scratch_path(spark, "marts"),
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build(spark, sf_dir)
    return _built[key]
