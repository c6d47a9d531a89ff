"""Structured Streaming ingest: messages -> mapped rows -> Parquet.

``ingest_stream`` is the production shape: one streaming plan from the
source (Kafka or message files) through decoding and mapping into the
Parquet file sink. The sink's metadata log plus the checkpoint make the
landing exactly-once: a restart resumes from the committed offsets and a
re-run of a batch never appends twice.

The checkpoint belongs to the output: unless one is named it lies in
``<path>/_checkpoint`` (readers skip it), so a later run into the same folder
goes on where the last one stopped and appends what is new. A folder whose
file-sink log was written under another checkpoint is refused, since the sink
would take the new run's first batches for written already.

``ingest_until_close`` adds the sentinel rule of the original consumer:
after a micro-batch that contained ``{"data": "close"}`` the query is
stopped. It writes each micro-batch that has rows into a directory of its own,
named by the query's id and the batch, with overwrite: a replayed batch
replaces rather than duplicates, and a run under a new checkpoint, which is
another query, adds to what is there.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludica.operators.ingest import is_close, messages_to_rows, quarantine_split
from ludica.schema import LANDED_COLUMNS, LANDED_SCHEMA


def checkpoint_of(path: str) -> str:
    """The checkpoint folder that belongs to an output folder."""
    return f"{path.rstrip('/')}/_checkpoint"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ingest_stream(source: DataFrame, path: str, checkpoint: str | None = None,
                  trigger: str | None = "availableNow", malformed: str = "null_row",
                  partition_by: list[str] | None = None, landing_date: bool = False,
                  distinct: bool = False):
    """Append mapped rows of every micro-batch to Parquet at ``path``.

    ``trigger``: ``"availableNow"`` processes what is there and stops (bounded
    runs, tests); any other string is a processing-time interval such as
    ``"30 seconds"`` (longer intervals mean fewer, larger files).
    ``landing_date`` adds an ``ingest_date`` directory partition (the date a
    batch landed), so later reads of recent data prune whole folders;
    ``load_landed`` drops the column again.
    ``distinct`` lands every row once (R1), however often and in whichever run
    it is delivered: the hashes of all landed rows (32 bytes each) are the
    query's state, in RocksDB under its checkpoint, so they survive restarts and
    do not have to fit in memory. The choice is made at the first run into a folder.
    """
    spark = source.sparkSession
    checkpoint = checkpoint or checkpoint_of(path)
    if _exists(spark, f"{path}/_spark_metadata") and not _exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} was written under another checkpoint than {checkpoint}: a run under a new one "
                         "would skip its first batches; name the old checkpoint or another output folder")
    rows = messages_to_rows(source, malformed=malformed)
    if distinct:
        rows = _first_of_equal_rows(rows)
    if landing_date:
        rows = rows.withColumn("ingest_date", F.current_date())
        partition_by = list(partition_by or []) + ["ingest_date"]
    w = (rows.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


#: Spark's state store that keeps state on the executors' disks, with its changes in the checkpoint.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _first_of_equal_rows(rows: DataFrame) -> DataFrame:
    """The first delivery of each row; 0.0 and -0.0 are equal, NULLs are too."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    cells = [(F.col(f.name) + F.lit(0).cast(f.dataType)).alias(f.name) if f.dataType.typeName() == "float" else F.col(f.name)
             for f in rows.schema.fields]
    text = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
    return rows.withColumn("_row", F.unhex(F.sha2(text, 256))).dropDuplicates(["_row"]).drop("_row")


def land_split(batch: DataFrame, batch_id: int | str, path: str, quarantine: str) -> None:
    """M1: the rows of a batch to ``path`` and its malformed messages to
    ``quarantine``, each in a folder of the batch's own that a replay replaces."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    batch = batch.persist()
    try:
        for rows, folder in zip(quarantine_split(batch), (path, quarantine), strict=True):
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{folder}/batch={query_id}-{batch_id}")
    finally:
        batch.unpersist()


def ingest_with_quarantine(source: DataFrame, path: str, quarantine: str, checkpoint: str | None = None,
                           trigger: str | None = "availableNow"):
    """M1 as one streaming query with two outputs. Both folders are named by the query's id and the
    batch, so a batch that is replayed after a failure, between its two writes too, lands once in each."""
    w = (source.writeStream.option("checkpointLocation", checkpoint or checkpoint_of(path))
         .foreachBatch(lambda batch, batch_id: land_split(batch, batch_id, path, quarantine)))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger) if trigger else w
    return w.start()


def load_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The malformed messages: raw_message and raw_record."""
    return spark.read.schema("raw_message string, raw_record string").parquet(path).select("raw_message", "raw_record")


def ingest_until_close(source: DataFrame, path: str, checkpoint: str | None = None,
                       trigger: str = "1 second", malformed: str = "null_row",
                       timeout_s: float | None = None) -> int:
    """M2: land batches until one carries the close sentinel; returns the
    number of micro-batches that contained it (0 on timeout)."""
    closed = threading.Event()

    def land(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        try:
            rows = messages_to_rows(batch, malformed=malformed)
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{path}/batch={query_id}-{batch_id}")
            if not batch.where(is_close()).isEmpty():
                closed.set()
        finally:
            batch.unpersist()

    q = (source.writeStream.foreachBatch(land)
               .option("checkpointLocation", checkpoint or checkpoint_of(path))
               .trigger(processingTime=trigger).start())
    waited = 0.0
    try:
        while not closed.wait(1.0):
            waited += 1.0
            if not q.isActive:           # the query failed or was stopped elsewhere
                err = q.exception()
                if err is not None:
                    raise RuntimeError(f"ingest stream failed: {err}")
                break
            if timeout_s is not None and waited >= timeout_s:
                break
    finally:
        q.stop()
    return 1 if closed.is_set() else 0


def load_landed(spark: SparkSession, path: str) -> DataFrame:
    """Read landed Parquet back with the declared 41-column schema."""
    return spark.read.schema(LANDED_SCHEMA).parquet(path).select(*[c for c, _ in LANDED_COLUMNS])


def compact(spark: SparkSession, path: str, out: str, files: int) -> None:
    """Rewrite a landed folder (many small per-batch files) as ``files`` files."""
    load_landed(spark, path).repartition(files).write.mode("overwrite").parquet(out)
