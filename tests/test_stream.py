"""Structured Streaming ingest: stream = batch, restart adds nothing,
close sentinel stops the loop."""

import os
import tempfile

import pytest

from ludica.operators.ingest import messages_to_rows
from ludica.schema import LANDED_COLUMNS
from ludica.sources.games import games
from ludica.sources.messages import catalog_to_sse_lines, read_message_files, sse_to_messages
from ludica.streaming import pipeline
from tests.conftest import SF_SMALL


def _write_messages(spark, root, parts=3):
    msgs = sse_to_messages(catalog_to_sse_lines(games(spark, SF_SMALL)))
    path = os.path.join(root, "msgs")
    msgs.repartition(parts).write.mode("overwrite").text(path)
    return msgs, path


def _sorted(rows):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


def test_stream_equals_batch_and_restart_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="ludica-stream-")
    msgs, src = _write_messages(spark, root)
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    stream = read_message_files(spark, src, streaming=True, max_files_per_trigger=1)
    pipeline.ingest_stream(stream, out, ckpt).awaitTermination()
    landed = pipeline.load_landed(spark, out)
    batch = messages_to_rows(msgs).select(*[c for c, _ in LANDED_COLUMNS])
    assert _sorted(landed.collect()) == _sorted(batch.collect())
    n = landed.count()
    # restart from the same checkpoint: nothing new to land
    stream2 = read_message_files(spark, src, streaming=True)
    pipeline.ingest_stream(stream2, out, ckpt).awaitTermination()
    assert pipeline.load_landed(spark, out).count() == n


def test_close_sentinel_stops_after_batch(spark):
    root = tempfile.mkdtemp(prefix="ludica-close-")
    src = os.path.join(root, "msgs")
    spark.createDataFrame([('{"data":"{\\"AppID\\":\\"1\\"}"}',), ('{"data":"close"}',),
                           ('{"data":"{\\"AppID\\":\\"2\\"}"}',)], "value string") \
        .coalesce(1).write.mode("overwrite").text(src)
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    stream = read_message_files(spark, src, streaming=True)
    closed = pipeline.ingest_until_close(stream, out, ckpt, trigger="1 second", timeout_s=60)
    assert closed == 1
    ids = sorted(r.appID for r in pipeline.load_landed(spark, out).collect())
    assert ids == ["1", "2"]          # the rest of the closing batch is still written


def test_landing_date_partitions(spark):
    root = tempfile.mkdtemp(prefix="ludica-date-")
    msgs, src = _write_messages(spark, root, parts=2)
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    stream = read_message_files(spark, src, streaming=True)
    pipeline.ingest_stream(stream, out, ckpt, landing_date=True).awaitTermination()
    assert any(d.startswith("ingest_date=") for d in os.listdir(out))
    landed = pipeline.load_landed(spark, out)
    assert landed.columns == [c for c, _ in LANDED_COLUMNS]
    assert landed.count() == messages_to_rows(msgs).count()


def test_compaction_keeps_rows(spark):
    root = tempfile.mkdtemp(prefix="ludica-compact-")
    msgs, src = _write_messages(spark, root, parts=4)
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    stream = read_message_files(spark, src, streaming=True, max_files_per_trigger=1)
    pipeline.ingest_stream(stream, out, ckpt).awaitTermination()
    compacted = os.path.join(root, "compacted")
    pipeline.compact(spark, out, compacted, files=2)
    assert len([f for f in os.listdir(compacted) if f.endswith(".parquet")]) == 2
    assert _sorted(pipeline.load_landed(spark, compacted).collect()) == \
        _sorted(pipeline.load_landed(spark, out).collect())


def _message(key):
    return '{"data":"{\\"AppID\\":\\"%s\\"}"}\n' % key


def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_two_runs_with_defaults_land_every_row(spark):
    root = tempfile.mkdtemp(prefix="ludica-twice-")
    src, out = os.path.join(root, "msgs"), os.path.join(root, "out")
    for run, keys in enumerate(("12", "345", "")):
        if keys:
            _file(src, f"{run}.txt", "".join(map(_message, keys)))
        pipeline.ingest_stream(read_message_files(spark, src, streaming=True), out).awaitTermination()
    assert sorted(r.appID for r in pipeline.load_landed(spark, out).collect()) == list("12345")


def test_a_foreign_checkpoint_is_refused(spark):
    root = tempfile.mkdtemp(prefix="ludica-foreign-")
    src, out = os.path.join(root, "msgs"), os.path.join(root, "out")
    _file(src, "a.txt", _message(1))
    pipeline.ingest_stream(read_message_files(spark, src, streaming=True), out).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        pipeline.ingest_stream(read_message_files(spark, src, streaming=True), out, os.path.join(root, "new"))


def test_close_loop_keeps_earlier_runs_and_writes_no_empty_batches(spark):
    root = tempfile.mkdtemp(prefix="ludica-close-twice-")
    src, out = os.path.join(root, "msgs"), os.path.join(root, "out")
    for run, keys in enumerate(("12", "34")):
        _file(src, f"{run}.txt", "".join(map(_message, keys)) + '{"data":"close"}\n')
        stream = read_message_files(spark, src, streaming=True)
        checkpoint = os.path.join(root, f"ckpt{run}")     # another query each time
        assert pipeline.ingest_until_close(stream, out, checkpoint, timeout_s=90) == 1
    landed = sorted(r.appID for r in pipeline.load_landed(spark, out).collect())
    assert landed == list("112234")      # the second query reads the first file again and adds
    _file(os.path.join(root, "only-close"), "c.txt", '{"data":"close"}\n')
    empty = os.path.join(root, "empty")
    stream = read_message_files(spark, os.path.join(root, "only-close"), streaming=True)
    assert pipeline.ingest_until_close(stream, empty, timeout_s=90) == 1
    assert not [d for d in os.listdir(empty) if d.startswith("batch=")]


def test_a_replayed_batch_lands_once_in_both_outputs(spark, tmp_path):
    from ludica.streaming.pipeline import land_split, load_landed, load_quarantined
    df = spark.createDataFrame([('{"data":"no json"}',), ('{"data":"{\\"AppID\\":\\"1\\"}"}',), ('{"data":"close"}',)], "value string")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for batch_id in (0, 0, 1):
        land_split(df, batch_id, out, bad)
    assert [r["appID"] for r in load_landed(spark, out).collect()] == ["1", "1"]
    assert [r["raw_record"] for r in load_quarantined(spark, bad).collect()] == ["no json", "no json"]


def test_rows_land_once_over_runs_and_restarts(spark, tmp_path):
    """The same file content three times, in three runs: the query is a new one each time, its state is kept."""
    from ludica.sources.messages import read_message_files
    from ludica.streaming.pipeline import ingest_stream, load_landed
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = ['{"data":"{\\"AppID\\":\\"%d\\",\\"Price\\":\\"%s\\"}"}' % (i % 5, price) for i in range(10) for price in ("0.0", "-0.0", "1")]
    for _ in range(3):
        spark.createDataFrame([(r,) for r in rows], "value string").write.mode("append").text(src)
        ingest_stream(read_message_files(spark, src, streaming=True), out, distinct=True).awaitTermination()
        assert sorted((r["appID"], r["price"]) for r in load_landed(spark, out).collect()) == [(str(i), p) for i in range(5) for p in (0.0, 1.0)]
