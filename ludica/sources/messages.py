"""Message sources and sinks.

Kafka is reached through Spark's own connector (``format("kafka")``; its
jar must be on the classpath of the cluster - it is not in this test
image). Text files carrying one message per line are the test twin of the
Kafka source: same ``value STRING`` column, same downstream plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludica.operators.ingest import ENVELOPE_KEY, java_trim

# --- fixed values: connection defaults of the catalogue pipeline
DEFAULT_TOPIC = "games"
DEFAULT_SERVERS = "localhost:9092"


def sse_to_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """Event-stream lines -> envelope messages ``{"data": text}``.

    Blank lines and ``event:`` / ``id:`` lines (tested on the trimmed line)
    are dropped; the ``data:`` prefix is stripped only when the raw line
    starts with it; the rest is trimmed and wrapped.
    """
    raw = F.col(value)
    t = java_trim(raw)
    keep = (t != "") & ~t.startswith("event:") & ~t.startswith("id:")
    text = F.when(raw.startswith("data:"), java_trim(F.substr(raw, F.lit(6)))).otherwise(t)
    return (lines.where(keep)
                 .select(F.to_json(F.struct(text.alias(ENVELOPE_KEY))).alias("value")))


def write_kafka(messages: DataFrame, servers: str = DEFAULT_SERVERS,
                topic: str = DEFAULT_TOPIC, checkpoint: str | None = None, **options):
    """Publish ``value`` (no key) to a topic; streaming or batch."""
    out = messages.select(F.col("value").cast("string").alias("value"))
    if out.isStreaming:
        w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic))
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        for k, v in options.items():
            w = w.option(k, v)
        return w.start()
    w = out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
    return None


def read_kafka(spark: SparkSession, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC,
               starting: str = "earliest", streaming: bool = True, **options) -> DataFrame:
    """S3: subscribe to one topic from ``starting`` offsets; ``value`` as text.

    Offsets are tracked in the streaming checkpoint (exactly-once with the
    file sink) rather than in a consumer group.
    """
    r = spark.readStream if streaming else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", starting))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str, streaming: bool = True,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files, one message per line, as ``value``."""
    if not streaming:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def catalog_to_sse_lines(games: DataFrame) -> DataFrame:
    """Event-stream lines for catalogue rows, as the upstream source emits
    them: an ``id:`` line, an ``event:`` line and a ``data:`` line carrying
    the record under its source keys. Used to drive the ingest path from the
    driver tables; some values are written in other accepted spellings
    (upper-case booleans, ``5.0``-style integers) so the coercion rules run.
    """
    from ludica.operators.ingest import RENAMES
    key = F.col("appID").cast("long")
    spell = {
        "peakCCU": F.when(key % 7 == 0, F.concat(F.col("peakCCU").cast("string"), F.lit(".0"))),
        "supportMac": F.when(key % 11 == 0, F.upper(F.col("supportMac").cast("string"))),
        "supportLinux": F.when(key % 13 == 0, F.lit("yes")),
        "achievements": F.when(key % 17 == 0, F.concat(F.lit(" "), F.col("achievements").cast("string"))),
    }
    kv = []
    for src, dst in RENAMES:
        if dst not in games.columns:
            continue
        plain = F.col(dst).cast("string")
        v = F.coalesce(spell[dst], plain) if dst in spell else plain
        if dst in spell:
            v = F.when(F.col(dst).isNull(), F.lit(None).cast("string")).otherwise(v)
        kv += [F.lit(src), v]
    record = F.to_json(F.create_map(*kv))
    lines = F.array(F.concat(F.lit("id: "), F.col("appID")), F.lit("event: game"),
                    F.concat(F.lit("data: "), record))
    return games.select(F.explode(lines).alias("value"))
