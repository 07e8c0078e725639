"""Checkpoints, progress logs, bounded batches and dead letters of streams."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from lakequality.session import work_dir
from lakequality.sources import files
from lakequality.streaming import checkpoints, progress, streams

NOW = "available now"


def folder(spark, label, n_files=3, rows=10):
    path = work_dir(spark, label)
    for k in range(n_files):
        spark.range(k * rows, (k + 1) * rows).coalesce(1).write.mode("append").parquet(path)
    return path


def run(spark, path, checkpoint, out, **bounds):
    stream = streams.append_stream(files.stream_files(spark, path, "id bigint", **bounds), checkpoint, path=out, interval=NOW)
    stream.awaitTermination()
    return stream


def rewrite(spark, path, text):
    fs, at = checkpoints._fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def test_checkpoint_faults_are_told_apart(spark):
    path, good, out = folder(spark, "in"), work_dir(spark, "checkpoint"), work_dir(spark, "out")
    assert checkpoints.faults(spark, good).count() == 0  # not begun
    run(spark, path, good, out, max_files=1)
    checkpoints.check(spark, good)
    offset = open(f"{good}/offsets/1").read()
    lines = offset.split("\n")
    cases = {
        "offsets/1: empty": lambda c: rewrite(spark, f"{c}/offsets/1", ""),
        "offsets/1: unknown version": lambda c: rewrite(spark, f"{c}/offsets/1", offset.replace("v1", "v9", 1)),
        "offsets/1: cut": lambda c: rewrite(spark, f"{c}/offsets/1", "\n".join(lines[:2])),
        "offsets/1: no JSON": lambda c: rewrite(spark, f"{c}/offsets/1", offset[:-3]),
        "commits/2: no JSON": lambda c: rewrite(spark, f"{c}/commits/2", 'v1\n{"next'),
        "commits/0: cut": lambda c: rewrite(spark, f"{c}/commits/0", "v1"),
        "offsets: batches missing": lambda c: os.remove(f"{c}/offsets/1"),
        "commits: more than one batch without a commit": lambda c: [os.remove(f"{c}/commits/{k}") for k in (1, 2)],
        "offsets: number of sources changes": lambda c: rewrite(spark, f"{c}/offsets/2", offset + "\n" + lines[2]),
        "metadata: empty": lambda c: rewrite(spark, f"{c}/metadata", ""),
        "metadata: missing": lambda c: os.remove(f"{c}/metadata"),
        "metadata: no JSON": lambda c: rewrite(spark, f"{c}/metadata", '{"id'),
        "metadata: no query id": lambda c: rewrite(spark, f"{c}/metadata", "{}"),
    }
    for fault, damage in cases.items():
        bad = work_dir(spark, "bad")
        checkpoints.save(spark, good, bad)
        damage(bad)
        with pytest.raises(checkpoints.CheckpointError, match=fault):
            checkpoints.check(spark, bad)
        if "missing" in fault and "offsets" in fault:
            assert {f"{r.place}: {r.fault}" for r in checkpoints.faults(spark, bad).collect()} >= {"commits/1: no offsets of this batch"}
        with pytest.raises(checkpoints.CheckpointError):
            checkpoints.save(spark, bad, work_dir(spark, "copy"))
    # The batch that was running when a stream broke off has no commit yet; that is sound.
    pending = work_dir(spark, "pending")
    checkpoints.save(spark, good, pending)
    os.remove(f"{pending}/commits/2")
    checkpoints.check(spark, pending)
    with pytest.raises(FileExistsError):
        checkpoints.save(spark, good, pending)


def test_restored_checkpoint_completes_the_table(spark):
    path, checkpoint, out, saved = folder(spark, "in"), work_dir(spark, "checkpoint"), work_dir(spark, "out"), work_dir(spark, "saved")
    run(spark, path, checkpoint, out)
    checkpoints.save(spark, checkpoint, saved)
    spark.range(30, 50).coalesce(1).write.mode("append").parquet(path)
    checkpoints.cut(spark, f"{checkpoint}/offsets/0", 40)
    with pytest.raises(checkpoints.CheckpointError):
        checkpoints.check(spark, checkpoint)
    # Spark itself fails on it too and writes nothing.
    with pytest.raises(Exception):
        run(spark, path, checkpoint, out)
    assert spark.read.parquet(out).count() == 30
    checkpoints.restore(spark, saved, checkpoint)
    assert os.path.isdir(f"{checkpoint}.broken")
    run(spark, path, checkpoint, out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(50))
    with pytest.raises(FileExistsError):
        checkpoints.restore(spark, saved, checkpoint)


def test_progress_outlives_the_query(spark):
    path, log = folder(spark, "in", n_files=7), work_dir(spark, "log")
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, 2)
    checkpoint, out = work_dir(spark, "checkpoint"), work_dir(spark, "out")
    try:
        with progress.logged(spark, log) as seen:
            for _ in range(2):  # the second run finds new files and goes on counting
                stream = run(spark, path, checkpoint, out, max_files=2)
                seen.wait(stream)
                assert len(stream.recentProgress) <= 2
                spark.range(100, 105).coalesce(1).write.mode("append").parquet(path)
    finally:
        spark.conf.set(name, before)
    rows = progress.read_progress(spark, log).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows) for r in rows] == [(0, 20), (1, 20), (2, 20), (3, 10), (4, 5)]
    assert len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 2
    assert all(r.durations["triggerExecution"] >= 0 and r.sources[0].input_rows == r.input_rows and r.date for r in rows)
    folded = work_dir(spark, "folded")
    progress.fold_progress(spark, log, folded)
    assert spark.read.parquet(folded).agg(F.sum("input_rows")).first()[0] == 75
    # A batch that was logged twice counts once.
    day = os.path.join(log, next(n for n in os.listdir(log) if n.startswith("date=")))
    one = next(n for n in sorted(os.listdir(day)) if n.endswith(".json"))
    shutil.copy(f"{day}/{one}", f"{day}/{one[:-5]}-again.json")
    assert progress.read_progress(spark, log).count() == 5


def test_progress_log_tells_of_failures(spark):
    path = folder(spark, "in", n_files=1)
    blocked = work_dir(spark, "blocked")
    os.makedirs(os.path.dirname(blocked), exist_ok=True)
    open(blocked, "w").close()  # a file where the folder should be
    with progress.logged(spark, blocked) as seen:
        stream = run(spark, path, work_dir(spark, "checkpoint"), work_dir(spark, "out"))
        with pytest.raises(Exception):
            seen.wait(stream)
        stranger = type("Query", (), {"runId": "none"})()
        with pytest.raises(TimeoutError):
            seen.wait(stranger, seconds=0.01)


def test_batches_are_bounded_by_the_source(spark):
    path = folder(spark, "in", n_files=5)
    with pytest.raises(ValueError, match="not both"):
        files.stream_files(spark, path, "id bigint", max_files=1, max_bytes="1m")
    size = max(os.path.getsize(f"{path}/{n}") for n in os.listdir(path) if n.endswith(".parquet"))
    for bounds, want in (({"max_files": 2}, [20, 20, 10]), ({"max_bytes": 2 * size}, [20, 20, 10]), ({"max_bytes": 1}, [10] * 5), ({}, [50])):
        out = work_dir(spark, "out")
        rows = files.stream_files(spark, path, "id bigint", **bounds)
        streams.batch_evidence(rows, out, work_dir(spark, "checkpoint"), interval=NOW).awaitTermination()
        admitted = spark.read.parquet(f"{out}/admitted").groupBy("batch_id").agg(F.sum("n").alias("n"), F.sum("bytes").alias("b")).orderBy("batch_id").collect()
        assert [r.n for r in admitted] == want
        if "max_bytes" in bounds and bounds["max_bytes"] > 1:
            assert all(r.b <= bounds["max_bytes"] for r in admitted)
        assert spark.read.parquet(f"{out}/rows").count() == 50


def test_json_documents_split_into_good_rows_and_dead_letters(spark):
    path, out = work_dir(spark, "json"), work_dir(spark, "out")
    os.makedirs(path)
    documents = {
        "a": json.dumps([{"id": 1, "v": 1.5}, {"id": 2, "v": None}], indent=2),
        "b": json.dumps({"id": 3, "v": 2, "other": "x"}, indent=2),
        "c": json.dumps([{"id": 4, "v": "high"}, {"id": 5, "v": 1}], indent=2),
        "d": json.dumps([{"id": 6, "v": 1.5}], indent=2)[:-4],
        "e": "no json",
        "f": "[]",
    }
    for name, text in documents.items():
        with open(f"{path}/{name}.json", "w") as file:
            file.write(text)
    rows = files.stream_json(spark, path, "id BIGINT, v DOUBLE", corrupt="broken", max_files=2)
    stream = streams.quarantined_batches(rows, F.col("broken").isNotNull(), out, work_dir(spark, "checkpoint"), source="feed", interval=NOW)
    stream.awaitTermination()
    good = streams.good_rows(spark, out, rows.schema).orderBy("id").collect()
    assert [(r.id, r.v, r.broken) for r in good] == [(1, 1.5, None), (2, None, None), (3, 2.0, None)]
    bad = streams.dead_letters(spark, out, rows.schema).collect()
    texts = [r.broken for r in bad]
    assert set(texts) == {documents[k] for k in "cde"} and len(bad) == 4
    assert {(r.dead_letter_reason, r.dead_letter_source) for r in bad} == {("corrupt record", "feed")}
    assert all(r.batch_id is not None for r in bad)
