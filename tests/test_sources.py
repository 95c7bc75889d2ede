"""Sources that plan their own ranges, the staged sink, restarts and batch metrics."""

import gzip
import io
import os
import random
import time
import zipfile

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidegauge.sinks import store
from tidegauge.sinks.tables import BatchFolder
from tidegauge.sources import archives, changed, files, paced, storage, streams
from tidegauge.streaming import runner


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(10 if x < 80 else 97 + x % 5 for x in b)), st.integers(1, 20))
def test_ranges_give_every_line_once(data, step):
    want = data.split(b"\n")[:-1] + ([data.split(b"\n")[-1]] if not data.endswith(b"\n") and data else [])
    got = []
    for at in range(0, len(data), step):
        for found in storage.lines(io.BytesIO(data), at, min(len(data), at + step), len(data)):
            got += found
    assert got == (want if data else [])
    assert storage.last_line_end(io.BytesIO(data), 0, len(data)) == data.rfind(b"\n") + 1


def test_lines_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(storage, "BLOCK", 3)
    test_ranges_give_every_line_once()


def watch(spark, folder, tmp_path, **options):
    spark.dataSource.register(changed.ChangedLines)
    df = spark.readStream.format("changed_lines").option("pattern", "*.csv").options(**options).load(folder)

    def run():
        out = runner.replay(df.select("value"), "changed", checkpoint=str(tmp_path / "cp"), path=str(tmp_path / "out"))
        rows = sorted(r.value for r in out.collect())
        new = list(rows)
        for v in run.seen:
            new.remove(v)
        run.seen = rows
        return new

    run.seen = []
    return run


def put(path, text, mode="w", at=None):
    with open(path, mode) as f:
        f.write(text)
    if at:
        os.utime(path, (at, at))


def test_changed_files_come_again(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    run = watch(spark, folder, tmp_path, split=7)
    put(f"{folder}/a.csv", "1,x\n2,y\n3,z", at=1_600_000_000)
    put(f"{folder}/b.txt", "no\n")
    assert run() == ["1,x", "2,y", "3,z"]
    assert run() == []
    put(f"{folder}/a.csv", "\n4,w\n", "a")
    put(f"{folder}/b.csv", "ünï\n", at=1_600_000_001)
    assert run() == ["1,x", "2,y", "3,z", "4,w", "ünï"]
    put(f"{folder}/a.csv", "5,v\n", at=1_600_000_002)  # overwritten
    assert run() == ["5,v"]
    os.utime(f"{folder}/b.csv", (1_600_000_009, 1_600_000_009))  # touched
    os.unlink(f"{folder}/a.csv")
    assert run() == ["ünï"]


def test_files_that_grow_give_new_lines(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    run = watch(spark, folder, tmp_path, growth="new")
    put(f"{folder}/a.csv", "1\n2\nunfin", at=1_600_000_000)
    assert run() == ["1", "2"]
    put(f"{folder}/a.csv", "ished", "a", at=1_600_000_001)
    assert run() == []
    put(f"{folder}/a.csv", "\n4\n", "a", at=1_600_000_002)
    assert run() == ["4", "unfinished"]
    put(f"{folder}/a.csv", "7\n8\n9\n10\n11\n12\n13\n14\n15\n", at=1_600_000_003)  # another file of that name, longer
    assert run() == sorted(str(i) for i in range(7, 16))
    put(f"{folder}/a.csv", "x\n", at=1_600_000_004)
    assert run() == ["x"]


def test_paced_replay_by_record(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for i, n in enumerate((37, 0, 5, 58)):
        rows = [f"{i}-{j}-{'x' * (j % 9)}" for j in range(n)]
        (folder / f"{i}.csv").write_text("".join(f"{r}\n" for r in rows))
        want += rows
    index = str(tmp_path / "index")
    assert paced.build_index(spark, str(folder), "*.csv", index, every=7, split=50) == len(want)
    out = BatchFolder(spark, str(tmp_path / "out"))

    def play(batches):
        df = paced.paced(spark, index, 33, str(tmp_path / "state.json"))
        q = df.writeStream.foreachBatch(out.write_batch).option("checkpointLocation", str(tmp_path / "cp")).trigger(
            processingTime="0 seconds").start()
        end = time.time() + 90
        while time.time() < end and not (q.lastProgress and q.lastProgress["batchId"] >= batches):
            time.sleep(0.05)
        q.stop()

    play(2)
    play(6)  # after a restart
    batches = sorted((n for n in os.listdir(tmp_path / "out")), key=lambda n: int(n.split("=")[1]))
    seen = []
    for name in batches:
        rows = sorted((r.number, r.value) for r in spark.read.parquet(str(tmp_path / "out" / name)).collect())
        if not rows and name == batches[-1]:
            continue
        assert len(rows) == 33
        seen += rows
    assert len(batches) >= 7
    assert [v for _, v in seen] == [want[i % len(want)] for i in range(len(seen))]
    assert [n for n, _ in seen] == list(range(len(seen)))


def test_archives_by_entry(spark, tmp_path):
    rng = random.Random(0)
    folder = tmp_path / "z"
    folder.mkdir()
    want = []

    def text(n):
        lines = ["".join(rng.choice("abcü, ") for _ in range(rng.randrange(40))) for _ in range(n)]
        want.extend(lines)
        return "\n".join(lines) + ("\n" if lines and (rng.random() < 0.5 or not lines[-1]) else "")

    with zipfile.ZipFile(folder / "many.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("sub")
        for i in range(40):
            z.writestr(f"sub/{i}.txt", text(rng.randrange(1, 30)), zipfile.ZIP_STORED if i % 3 == 0 else zipfile.ZIP_DEFLATED)
        z.writestr("big.txt", text(30_000))
        z.writestr("empty.txt", "")
    with zipfile.ZipFile(folder / "none.csv.zip", "w"):
        pass
    (folder / "p.csv").write_text("plain\n")
    with gzip.open(folder / "g.csv.gz", "wt") as f:
        f.write("packed\n")
    (folder / "other.zip").write_bytes(b"no archive")
    rows = files.read_lines(spark, str(folder))
    assert sorted(r.value for r in rows.collect()) == sorted([*want, "plain", "packed"])
    zips = spark.createDataFrame([(str(folder / "many.csv.zip"),)], "path string")
    read = archives.read_archives(zips, task_bytes=1 << 12)
    with_rows = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(with_rows) >= 10 and sum(r["count"] for r in with_rows) == len(want)


def test_an_archive_that_ends_inside_an_entry(spark, tmp_path):
    path = tmp_path / "a.csv.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a", "x\n" * 100)
    found = archives.entries(spark.createDataFrame([(str(path),)], "path string")).collect()
    broken = spark.createDataFrame([(r.path, r.entry, r.place, r.header, r.method, 10_000, r.size) for r in found], archives._ENTRY)
    with pytest.raises(Exception, match="ends inside an entry"):
        archives.entry_lines(broken).collect()


SCHEMA = "id bigint, v string"


def test_staged_rows_of_killed_tasks_and_repeated_epochs(spark, tmp_path):
    path = str(tmp_path / "out")
    stage = store.Stage({"path": path})
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "v": ["a", "b"]})

    def killed():
        yield batch
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        stage.stage(killed())
    assert [f for f in os.listdir(path) if f.endswith(".parquet")] == []
    writer, lost = store.StreamWriter(stage), stage.stage(iter([batch]))  # a task that was lost after it wrote
    writer.commit([writer.write(iter([batch])), None, writer.write(iter([]))], 0)
    assert sorted(r.id for r in store.read_staged(spark, path, SCHEMA).collect()) == [1, 2]
    writer.commit([writer.write(iter([batch]))], 0)  # the epoch again
    assert store.read_staged(spark, path, SCHEMA).count() == 2
    message = writer.write(iter([batch]))
    writer.abort([message, None], 1)
    assert store.read_staged(spark, path, SCHEMA).count() == 2
    assert store.sweep(path, time.time_ns() + 10**9) == [lost.file]
    assert store.read_staged(spark, path, SCHEMA).count() == 2


def deliver(spark, folder, parts):
    os.makedirs(folder, exist_ok=True)
    for i, ids in enumerate(parts):
        (spark.createDataFrame([(k, f"v{k}") for k in ids], SCHEMA).toPandas()).to_parquet(f"{folder}/{i}.parquet")
        os.utime(f"{folder}/{i}.parquet", (1_600_000_000 + i, 1_600_000_000 + i))


def test_stream_and_batch_through_the_provider(spark, tmp_path):
    deliver(spark, str(tmp_path / "in"), [range(0, 50), range(50, 70)])
    spark.dataSource.register(store.StagedRows)
    path = str(tmp_path / "out")
    for _ in range(2):  # the second run has nothing to do
        df = streams.files(spark, str(tmp_path / "in"), SCHEMA, max_files=1).repartition(4)
        df.writeStream.format("staged_rows").option("path", path).option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in store.read_staged(spark, path, SCHEMA).collect()) == list(range(70))
    spark.createDataFrame([(100, "x")], SCHEMA).write.format("staged_rows").mode("append").option("path", path).save()
    assert store.read_staged(spark, path, SCHEMA).count() == 71
    assert len(os.listdir(f"{path}/_log")) == 3


def test_a_failing_task_is_repeated_without_leftovers(spark, tmp_path):
    spark.dataSource.register(store.StagedRows)
    path = str(tmp_path / "out")

    @F.udf("bigint")
    def fails(i):
        if i == 15:
            raise RuntimeError("a task fails")
        return i

    df = spark.range(20).repartition(4).select(fails("id").alias("id"), F.lit("v").alias("v"))
    with pytest.raises(Exception, match="a task fails"):
        df.write.format("staged_rows").mode("append").option("path", path).save()
    # Tasks that ended after the job was given up may have left files, which no reader sees.
    assert store.read_staged(spark, path, SCHEMA).count() == 0
    store.sweep(path, time.time_ns() + 10**9)
    assert not os.path.isdir(path) or [f for f in os.listdir(path) if f.endswith(".parquet")] == []


@pytest.mark.parametrize("failures,ends", [(2, True), (6, False)])
def test_supervised_restart(spark, tmp_path, failures, ends):
    deliver(spark, str(tmp_path / "in"), [range(0, 10), range(10, 20), range(20, 30)])
    out, left, seen = BatchFolder(spark, str(tmp_path / "out")), [failures], []

    def write(batch, batch_id):
        out.write_batch(batch, batch_id)  # written, then lost
        if batch_id == 1 and left[0]:
            left[0] -= 1
            raise RuntimeError("the store is away")

    def begin():
        return runner.start(streams.files(spark, str(tmp_path / "in"), SCHEMA, max_files=1), write, str(tmp_path / "cp"),
                            f"supervised-{failures}", available_now=True)

    if ends:
        assert runner.supervise(begin, delay=0.01, failed=lambda n, e: seen.append(n)) == 2
        assert sorted(r.id for r in out.read().collect()) == list(range(30))
        assert seen == [0, 1]
    else:
        with pytest.raises(StreamingQueryException):
            runner.supervise(begin, delay=0.01, failed=lambda n, e: seen.append(n))
        assert seen == [0, 1, 2, 3, 4, 5]


def test_metrics_of_batches_as_a_table(spark, tmp_path):
    deliver(spark, str(tmp_path / "in"), [range(0, 10), range(10, 25)])
    table = runner.MetricsTable(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(table)
    try:
        df = runner.observed(streams.files(spark, str(tmp_path / "in"), SCHEMA, max_files=1), "served", F.count("*").alias("usage"),
                             F.max("id").alias("last"))
        runner.replay(df, "measured")
        end, rows = time.time() + 30, []
        while time.time() < end and len(rows) < 4:
            time.sleep(0.2)
            rows = table.read().where("metric = 'served' and rows > 0").collect() if os.path.isdir(table.path) else []
    finally:
        spark.streams.removeListener(table)
    assert sorted((r.batch, r.name, r.value) for r in rows) == [(0, "last", 9.0), (0, "usage", 10.0), (1, "last", 24.0),
                                                                (1, "usage", 15.0)]
    assert all(r.query == "measured" and r.millis >= 0 for r in rows)
