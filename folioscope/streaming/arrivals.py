"""File-arrival streams over the batch operators. A re-sent file or cell replaces what it sent before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioscope.operators.ledger import classify_attempts, final_attempt, rollup_year_status
from folioscope.scale import settle
from folioscope.sources.tables import _optional, _replace_partitions
from folioscope.sources.workbooks import explode_workbooks, with_place

FILE = ["amc", "period", "source_file"]
BINARY = "path string, modificationTime timestamp, length long, content binary"
ATTEMPTS = "amc string, period string, attempt long, exit_code int, message string, timed_out boolean"


def _replace_files(spark: SparkSession, path: str, files: DataFrame, rows: DataFrame) -> None:
    """Rows of ``files`` in a table by (amc, period) give way to ``rows``, also where a file has none now.

    A file without rows keeps one blank row, so that its folder is rewritten; ``read_cells`` and
    ``read_rejects`` leave those out.
    """
    blank = files.join(rows.select(*FILE).distinct(), FILE, "left_anti")
    for field in rows.schema.fields:
        if field.name not in FILE:
            blank = blank.withColumn(field.name, F.lit(None).cast(field.dataType))
    fresh = rows.unionByName(blank.select(*rows.columns))
    stored = _optional(lambda: spark.read.schema(rows.schema).parquet(path).select(*rows.columns), spark, rows.schema)
    others = stored.join(files.select("amc", "period").distinct(), ["amc", "period"], "left_semi").join(files, FILE, "left_anti")
    _replace_partitions(settle(others.unionByName(fresh)), path, ["amc", "period"])


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("sheet IS NOT NULL")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("reason IS NOT NULL")


def stream_workbooks(spark: SparkSession, landing: str, cells_path: str, rejects_path: str, checkpoint: str,
                     files_per_trigger: int = 200) -> StreamingQuery:
    """New workbooks of a landing folder -> cells and rejects, partitioned by house and month.

    A file that is sent again replaces what it left in both outputs, whether it was whole before or is now.
    """
    files = (
        spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xls*").option("maxFilesPerTrigger", files_per_trigger).load(landing)
    )

    def save(batch: DataFrame, _: int) -> None:
        placed = with_place(batch)
        cells, rejects = explode_workbooks(placed)
        sent = placed.select(*FILE).distinct()
        _replace_files(spark, cells_path, sent, cells)
        _replace_files(spark, rejects_path, sent, rejects)

    return files.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_ledger(spark: SparkSession, attempts_path: str, ledger_path: str, checkpoint: str, today: str,
                  lag_months: int = 3, retries: int = 3) -> StreamingQuery:
    """New attempt rows -> ledger of the houses they name.

    A house's ledger is made anew from all its attempts, stored and new, so the order in which they arrive
    does not matter: the attempt that ended each month, then the roll-up by year.
    """
    attempts = spark.readStream.schema(ATTEMPTS).json(attempts_path)

    def save(batch: DataFrame, _: int) -> None:
        houses = batch.select("amc").distinct()
        known = spark.read.schema(ATTEMPTS).json(attempts_path).join(houses, "amc", "left_semi")
        ended = final_attempt(classify_attempts(known, F.lit(today).cast("date"), lag_months), retries)
        ledger = rollup_year_status(ended.select("amc", "year", "month", "status", "description", "error"))
        _replace_partitions(settle(ledger), ledger_path, ["amc"])

    return attempts.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
