"""Small builders shared by the tests."""

import datetime as dt

from hearth import schemas


def utc(text):
    return dt.datetime.fromisoformat(text)


def iot(spark, rows):
    """Rows ``(entity_id, state, last_changed text)`` as a bronze frame."""
    full = [(utc("2025-01-01"), e, s, utc(t) if t else None, "{}") for e, s, t in rows]
    return spark.createDataFrame(full, schemas.BRONZE_IOT)


def weather(spark, rows):
    """Rows ``(condition, last_changed text, temperature)`` as a bronze frame."""
    full = [
        (utc("2025-01-01"), schemas.WEATHER_ENTITY, c, utc(t), temp) + (None,) * 8 for c, t, temp in rows
    ]
    return spark.createDataFrame(full, schemas.BRONZE_WEATHER)


def price(spark, rows, zone="EE"):
    """Rows ``(ts text, price[, ingested text])`` as a bronze frame."""
    full = [(utc(r[2]) if len(r) > 2 else utc("2025-01-01"), utc(r[0]), zone, "EUR", float(r[1])) for r in rows]
    return spark.createDataFrame(full, schemas.BRONZE_PRICE)


def devices(spark, rows=None):
    day = dt.date.fromisoformat
    rows = rows or [
        ("Daikin", "Altherma_3_RF_08kW", 800.0, 8000.0, day("2023-10-15"), day("2024-01-31")),
        ("Mitsubishi Electric", "Ecodan_PUZ-WM60VHA", 600.0, 6000.0, day("2024-02-01"), day("2025-01-09")),
        ("Daikin", "Altherma_3_RF_08kW", 800.0, 8000.0, day("2025-01-10"), day("9999-12-31")),
    ]
    return spark.createDataFrame(rows, schemas.BRONZE_DEVICE)


def locations(spark):
    day = dt.date.fromisoformat
    rows = [
        ("Tallinn", "Tallinn-Harku", "EE_North", day("2023-01-01"), day("2023-06-30")),
        ("Tartu", "Tartu-Toravere", "EE_South", day("2023-07-01"), day("2024-05-31")),
        ("Tartu", "Tartu-Toravere", "EE_South", day("2024-06-01"), day("2025-06-30")),
        ("Tartu", "Tartu-Toravere", "EE_South", day("2025-07-01"), day("9999-12-31")),
    ]
    return spark.createDataFrame(rows, schemas.BRONZE_LOCATION)


def build(spark, folder, readings, *, observed=(), prices=(), device_rows=None):
    from hearth.plans.calendar import holidays
    from hearth.plans.star import build_star

    return build_star(
        bronze_iot=iot(spark, readings),
        bronze_weather=weather(spark, list(observed)),
        bronze_price=price(spark, list(prices)),
        bronze_device=devices(spark, device_rows),
        bronze_location=locations(spark),
        holidays=holidays(spark, 2020, 2040),
        root=folder,
    )


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def executions(spark, job):
    """What the session's status store has of the queries that ``job`` ran, and the store."""
    store = spark._jsparkSession.sharedState().statusStore()

    def listed():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return store.executionsList()

    found = listed()
    last = found.apply(found.size() - 1).executionId() if found.size() else -1
    job()
    found, out = listed(), []
    for i in reversed(range(found.size())):
        if found.apply(i).executionId() <= last:
            break
        out.append(found.apply(i))
    return out[::-1], store
