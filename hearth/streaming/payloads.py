"""Landed API payloads as a stream: good documents to bronze, broken ones to a quarantine."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..paths import delete
from ..sinks import staged_batch, upsert_rows
from ..sources.payloads import parse_documents, payload_rows


def _as_they_are(rows: DataFrame) -> DataFrame:
    return rows


def stream_documents(spark: SparkSession, path: str, *, per: str = "line", files_per_trigger: int | None = None) -> DataFrame:
    """Landed JSON documents as a stream of one text column ``value``; each file is read once."""
    if per not in ("line", "file"):
        raise ValueError("per must be 'line' or 'file'")
    reader = spark.readStream.option("wholetext", per == "file")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def payload_sink(
    kind: str,
    table: str,
    ts: str,
    keys: Sequence[str],
    quarantine: str,
    *,
    zone: str = "ee",
    keep: Callable[[DataFrame], DataFrame] = _as_they_are,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function from documents to the day-partitioned ``table`` of their kind.

    A batch is parsed once, by the write that stages it, and its rows are taken out of
    the parsed documents once, by the write that stages them for the table. Rows of good documents replace
    stored rows of their ``keys``; of several versions in a batch the newest counts. What
    fits nowhere goes to a folder of the batch below ``quarantine``: ``documents`` that are
    broken and rows that are ``untimed``. One broken document does not hold up the rest of
    a stream, which no one is there to repeat. A batch that is run again changes nothing:
    its rows replace themselves and its quarantine folder is written anew. ``kind`` as in
    :func:`hearth.sources.payloads.parse_documents`; ``keep`` may filter the rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_documents(batch, kind, zone=zone)
        documents = parsed.select(F.when(F.col("is_broken"), F.col("value")).alias("value"), "payload", "is_broken")
        folder = f"{quarantine.rstrip('/')}/batch-{batch_id:012d}"
        with staged_batch(documents, table, broken=F.count_if("is_broken")) as (staged, told):
            delete(batch.sparkSession, folder)
            if told["broken"]:
                staged.filter("is_broken").select("value").write.parquet(f"{folder}/documents")
            rows = keep(payload_rows(staged.filter("NOT is_broken").select("payload"), kind, zone=zone))
            untimed, seen = F.col(ts).isNull(), Observation()
            observed = rows.observe(seen, F.count_if(untimed).alias("untimed"))
            upsert_rows(observed.filter(~untimed), table, ts, keys)
            if seen.get["untimed"]:
                rows.filter(untimed).write.parquet(f"{folder}/untimed")

    return write


def quarantined(spark: SparkSession, quarantine: str, part: str, schema) -> DataFrame:
    """Broken ``documents`` or ``untimed`` rows of all batches."""
    found = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return found.parquet(f"{quarantine.rstrip('/')}/batch-*/{part}")
