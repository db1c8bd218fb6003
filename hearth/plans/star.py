"""Build and store the star schema.

Staging frames are written first: the calendar and the fact both read them, so
each bronze table is scanned once, and a lost executor re-reads a small hourly
table instead of the bronze log.

A build goes into a folder of its own and is published by one small file at the
end. Surrogate keys change from build to build unless a registry keeps them, and
calendar and fact must be seen together or not at all: a reader follows the last published file, and a build
that dies leaves the star before it in place. A reader that outlives two builds
pins the version it reads.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gold, silver
from .access import full_access, limited_access
from ..paths import delete, names, touch
from ..schemas import SENSOR_COLUMNS
from ..sinks import materialize
from ..together import together


@dataclass(frozen=True)
class Star:
    """The stored models of one build."""

    stg_iot: DataFrame
    stg_weather: DataFrame
    stg_price: DataFrame
    dim_time: DataFrame
    dim_device: DataFrame
    dim_location: DataFrame
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_time": self.dim_time,
            "dim_device": self.dim_device,
            "dim_location": self.dim_location,
            "fact": self.fact,
        }


def build_star(
    *,
    bronze_iot: DataFrame,
    bronze_weather: DataFrame,
    bronze_price: DataFrame,
    bronze_device: DataFrame,
    bronze_location: DataFrame,
    holidays: DataFrame,
    root: str,
    sensors: Mapping[str, str] = SENSOR_COLUMNS,
) -> Star:
    """Write staging, dimensions and fact as a new version below ``root``, publish and return them."""
    return assemble_star(
        stg_iot=silver.stg_iot(bronze_iot, sensors),
        stg_weather=silver.stg_weather(bronze_weather),
        stg_price=silver.stg_price(bronze_price),
        bronze_device=bronze_device,
        bronze_location=bronze_location,
        holidays=holidays,
        root=root,
    )


def assemble_star(
    *,
    stg_iot: DataFrame,
    stg_weather: DataFrame,
    stg_price: DataFrame,
    bronze_device: DataFrame,
    bronze_location: DataFrame,
    holidays: DataFrame,
    root: str,
    registry: str | None = None,
    touched: Sequence | None = None,
) -> Star:
    """A new version from hourly staging frames, which are written with it.

    With a ``registry`` folder every key stays what it was in earlier versions. Then
    ``touched`` may name the days (UTC) of all hours that changed since the last version:
    fact rows of other hours are taken over from it, unless device or location versions
    changed. The calendar, a row per hour, is always made anew, with its keys from the
    registry.
    """
    if touched is not None and registry is None:
        raise ValueError("without a registry keys change, and no fact can be taken over")
    spark = stg_iot.sparkSession
    before = read_star(spark, root) if touched is not None and published(spark, root) else None
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root.rstrip('/')}/versions/{version}"

    def table(name: str, model: Callable[..., DataFrame], *inputs, **named) -> DataFrame:
        return materialize(model(*inputs, **named), "table", name, folder)

    stg_iot, stg_weather, stg_price, dim_device, dim_location = together(
        spark,
        partial(materialize, stg_iot, "table", "stg_iot", folder),
        partial(materialize, stg_weather, "table", "stg_weather", folder),
        partial(materialize, stg_price, "table", "stg_price", folder),
        partial(table, "dim_device", gold.dim_device, bronze_device, registry=registry),
        partial(table, "dim_location", gold.dim_location, bronze_location, registry=registry),
    )
    hours = gold.needed_hours(stg_iot, stg_weather, stg_price)
    dim_time = table("dim_time", gold.dim_time, hours, holidays, registry=registry)
    if before is not None and not (_equal(before.dim_device, dim_device) and _equal(before.dim_location, dim_location)):
        before = None
    changed = _on(stg_iot, "hour_start", touched) if before is not None else stg_iot
    taken_over = _untouched(before, touched) if before is not None else None
    fact = table(
        "fact",
        _with_rows(gold.fact_energy, taken_over),
        stg_iot=changed,
        stg_weather=stg_weather,
        stg_price=stg_price,
        dim_time=dim_time,
        dim_device=dim_device,
        dim_location=dim_location,
        stage_path=f"{folder}/_fact_stage",
        registry=registry,
    )
    _publish(spark, root, version)
    return Star(stg_iot, stg_weather, stg_price, dim_time, dim_device, dim_location, fact)


def _on(df: DataFrame, ts: str, days: Sequence) -> DataFrame:
    return df.filter(F.to_date(F.col(ts)).isin(list(days))) if days else df.filter(F.lit(False))


def _equal(left: DataFrame, right: DataFrame) -> bool:
    """Whether two dimensions have the same rows."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def _untouched(star: Star, days: Sequence) -> DataFrame:
    """Fact rows of hours on other days; their keys hold in every version of one registry."""
    hours = _on(star.dim_time, "HourTs", days).select("TimeKey")
    return star.fact.join(hours, "TimeKey", "left_anti").select(*star.fact.columns)


def _with_rows(model: Callable[..., DataFrame], more: DataFrame | None) -> Callable[..., DataFrame]:
    """The model with rows that need not be computed."""
    return lambda **inputs: model(**inputs).unionByName(more) if more is not None else model(**inputs)


def register_star(star: Star) -> None:
    """Temp views for SQL users, with both access views."""
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name if name != "fact" else "fact_heating_energy_usage")
    materialize(full_access(star.fact), "view", "v_heating_energy_full_access")
    materialize(limited_access(star.fact), "view", "v_heating_energy_limited_access")


def published(spark: SparkSession, root: str) -> list[str]:
    """Names of the published versions, oldest first; names begin with their time."""
    return names(spark, f"{root.rstrip('/')}/published")


def _pinned(spark: SparkSession, root: str) -> set[str]:
    """Versions that any owner has pinned."""
    folder = f"{root.rstrip('/')}/pins"
    return {version for owner in names(spark, folder) for version in names(spark, f"{folder}/{owner}")}


def _publish(spark: SparkSession, root: str, version: str) -> None:
    """Make a finished version the current one, then delete all but it, the one before and those pinned.

    Creating an empty file is one step, so readers see either star. The version
    before stays for readers that have begun with it; folders of builds that died go too.
    """
    base = root.rstrip("/")
    touch(spark, f"{base}/published/{version}")
    current = published(spark, root)
    kept = {*current[-2:], *_pinned(spark, root)}
    dropped = [name for name in current if name not in kept and name < version]
    for name in dropped:
        delete(spark, f"{base}/published/{name}")
    # a pin set meanwhile was set before its version's marker went, or its owner looks for another version
    kept |= _pinned(spark, root)
    for name in dropped:
        if name in kept:
            touch(spark, f"{base}/published/{name}")
    for name in names(spark, f"{base}/versions"):
        if name not in kept and name < version:
            delete(spark, f"{base}/versions/{name}")


def unpin(spark: SparkSession, root: str, owner: str) -> None:
    """Give up an owner's pins; the next build may delete what nothing else keeps."""
    delete(spark, f"{root.rstrip('/')}/pins/{owner}")


def pin(spark: SparkSession, root: str, owner: str, version: str | None = None) -> str:
    """Keep one version, by default the current one, for a reader that outlives two builds.

    ``owner`` names the reader and holds one version at a time: the pin replaces its
    earlier ones, also those that a reader of this name left when it died. The pin stands
    before the version is looked up again, so a build that ends meanwhile either sees the
    pin or has made a newer version current, which is then taken.
    """
    if not owner or "/" in owner:
        raise ValueError("an owner is a name without slashes")
    folder = f"{root.rstrip('/')}/pins/{owner}"
    while True:
        found = published(spark, root)
        wanted = version if version is not None else (found[-1] if found else None)
        if wanted is None or wanted not in found:
            raise FileNotFoundError(f"no star {version or ''} was published below {root}")
        touch(spark, f"{folder}/{wanted}")
        if wanted in published(spark, root):
            break
        delete(spark, f"{folder}/{wanted}")
    for other in names(spark, folder):
        if other != wanted:
            delete(spark, f"{folder}/{other}")
    return wanted


@contextmanager
def pinned_star(spark: SparkSession, root: str, owner: str) -> Iterator[Star]:
    """The current star, which no build deletes within the block."""
    version = pin(spark, root, owner)
    try:
        yield read_star(spark, root, version)
    finally:
        unpin(spark, root, owner)


def read_star(spark: SparkSession, root: str, version: str | None = None) -> Star:
    """The models of the last published build, or of a named one."""
    versions = published(spark, root)
    if not versions or (version is not None and version not in versions):
        raise FileNotFoundError(f"no star {version or ''} was published below {root}")
    folder = f"{root.rstrip('/')}/versions/{version or versions[-1]}"
    models = ["stg_iot", "stg_weather", "stg_price", "dim_time", "dim_device", "dim_location", "fact"]
    return Star(*[spark.read.parquet(f"{folder}/{name}") for name in models])
