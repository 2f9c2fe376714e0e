"""Load on file arrival, and on a clock.

Two sources feed the stream: the files that arrive, and a clock. So batches run without an
arrival, and what no arrival announces is loaded by the next tick: a file whose quiet time
has ended, a failed file that has been mended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators.pending import FAILED, SOURCE, pending_files
from gridloom.plans.ingest import load_listed
from gridloom.sources.listing import ARCHIVES, list_files
from gridloom.sources.tables import FACTS, LEDGER

# Columns of Spark's binary file source; a stream has to name them.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Shortest time between two loads of a running stream, and a file's quiet time before it is loaded.
TRIGGER = "60 seconds"
QUIET_SECONDS = 0


def arriving_files(spark: SparkSession, prefix: str, name_glob: str = ARCHIVES, per_trigger: int = 10_000) -> DataFrame:
    """Stream of ``path``, ``length``, ``modificationTime`` of new files; bodies are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", per_trigger)
        # Otherwise a file much older than the newest one seen would never be offered.
        .option("maxFileAge", "36500d")
        .load(prefix)
        .select("path", "length", "modificationTime")
    )


def clock(spark: SparkSession) -> DataFrame:
    """A row each second with the columns of :func:`arriving_files`; it has no path."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.select(F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("length"), F.col("timestamp").alias("modificationTime"))


def changed_since_failure(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Leaves out files whose last attempt failed and that have not changed since."""
    last = ledger.groupBy(F.col(SOURCE).alias("path")).agg(
        F.max("updated_at").alias("_tried"), F.max_by("status", "updated_at").alias("_status")
    )
    known = files.join(last, "path", "left")
    same = (F.col("_status") == FAILED) & (F.col("modificationTime") < F.col("_tried"))
    return known.where(~F.coalesce(same, F.lit(False))).select(files.columns)


def load_arrivals(
    spark: SparkSession,
    schema: str,
    prefix: str,
    checkpoint: str,
    available_now: bool = True,
    retry_failed: bool = True,
    quiet_seconds: int = QUIET_SECONDS,
    name_glob: str = ARCHIVES,
    trigger: str = TRIGGER,
    **options,
) -> StreamingQuery:
    """Starts a stream that loads files as they arrive.

    The ledger decides what is loaded: a batch leaves out what it already marks, so
    a batch that is played again loads nothing twice. Only one load runs at a time, since
    batches follow each other.

    The checkpoint never offers a file again. So with ``retry_failed`` the start lists the
    prefix against the ledger, and so does every batch that is a tick of the clock or brings
    a file that is not loaded yet; a batch whose files an earlier listing has loaded lists
    nothing. Files that changed less than ``quiet_seconds`` ago wait for a later tick.
    Failed files are tried again at the start and, once they have changed, by a tick.
    """

    def settled(files: DataFrame) -> DataFrame:
        return files.where(F.col("modificationTime") <= F.expr(f"current_timestamp() - interval {int(quiet_seconds)} seconds"))

    def load_new(own: SparkSession, batch: DataFrame) -> None:
        arrived = batch.where(F.col("path").isNotNull())
        ledger = own.table(f"{schema}.{LEDGER}")
        if not retry_failed:
            load_listed(own, schema, settled(arrived), **options)
        elif arrived.isEmpty() or not pending_files(arrived, ledger, options.get("decode_uris", True)).isEmpty():
            files = settled(list_files(own, prefix, name_glob))
            load_listed(own, schema, changed_since_failure(files, ledger), **options)

    if retry_failed:
        load_listed(spark, schema, settled(list_files(spark, prefix, name_glob)), **options)

    def load(batch: DataFrame, _batch_id: int) -> None:
        # The batch runs in a session of its own, which keeps its own file listings.
        own = batch.sparkSession
        own.catalog.refreshTable(f"{schema}.{LEDGER}")
        load_new(own, batch)
        for table in (FACTS, LEDGER):
            spark.catalog.refreshTable(f"{schema}.{table}")

    both = arriving_files(spark, prefix, name_glob).unionByName(clock(spark))
    writer = both.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()
