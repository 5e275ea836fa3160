import datetime as dt

import pytest

from pyspark.sql import functions as F

from loomset.session import scratch_path
from loomset.sources import readers
from loomset.streaming import jobs


def _write(spark, rows, schema, path, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(path)


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def test_breaker_keeps_state_over_batches(spark):
    path, schema = scratch_path(spark, "t-breaker"), "user_id long, event_id long, ts timestamp"
    _write(spark, [(1, i, at(i)) for i in range(4)], schema, path, "a")
    _write(spark, [(1, 4, at(4)), (1, 5, at(8)), (1, 6, at(30))], schema, path, "b")
    _write(spark, [(2, 7, at(60))], schema, path, "c")
    made = jobs.drain(jobs.circuit_breaker(_stream(spark, path, schema), "user_id"), "t-breaker-out", settings=jobs.ROCKSDB)
    got = [(r.event_id, r.ts, r.failures, r.open) for r in made.orderBy("ts").collect()]
    assert [g[2:] for g in got] == [(1, False), (2, False), (3, False), (4, False), (5, True), (6, True), (0, False), (1, False)]
    assert got[6][:2] == (None, at(13))


def test_closed_windows_only(spark):
    path, schema = scratch_path(spark, "t-rate"), "ts timestamp"
    _write(spark, [(at(m),) for m in (1, 2, 59, 61, 200)], schema, path, "a")
    made = jobs.drain(jobs.rate(_stream(spark, path, schema), "ts", "10 minutes", "1 hour"), "t-rate-out")
    assert [(r.start, r.n) for r in made.orderBy("start").collect()] == [(at(0), 3), (at(60), 1)]


def test_first_arrival_over_batches(spark):
    path, schema = scratch_path(spark, "t-first"), "digest string, ts timestamp"
    _write(spark, [("x", at(0)), ("y", at(1))], schema, path, "a")
    _write(spark, [("x", at(2)), ("z", at(3))], schema, path, "b")
    made = jobs.drain(jobs.first_arrivals(_stream(spark, path, schema), ["digest"], "ts", "1 hour"), "t-first-out")
    assert sorted(r.digest for r in made.collect()) == ["x", "y", "z"]


def test_upsert_keeps_the_latest(spark):
    path, schema = scratch_path(spark, "t-up"), "run long, epoch long, metric double, ts timestamp"
    _write(spark, [(1, 1, 0.5, at(1)), (1, 2, 0.6, at(2))], schema, path, "a")
    _write(spark, [(1, 1, 0.7, at(9))], schema, path, "b")
    out = scratch_path(spark, "t-up-out")
    jobs.upsert_latest(_stream(spark, path, schema), out, scratch_path(spark, "t-up-marks"), ["run", "epoch"], ["ts"])
    got = {(r.run, r.epoch): r.metric for r in jobs.read_latest(spark, out, ["run", "epoch"], ["ts"]).collect()}
    assert got == {(1, 1): 0.7, (1, 2): 0.6}


def test_files_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes("né".encode())
    (tmp_path / "sub" / "b.md").write_bytes("né".encode("latin-1"))
    (tmp_path / "c.bin").write_bytes(b"x")
    got = {r.extension: r.text_content for r in readers.scan_text_files(spark, str(tmp_path)).collect()}
    assert got == {"txt": "né", "md": "né"}


def test_bad_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": 2}\n')
    from pyspark.sql import types as T

    rows = readers.scan_jsonl_lenient(spark, str(tmp_path), T.StructType.fromDDL("a long"))
    assert sorted((r.malformed, r.a) for r in rows.select("malformed", F.coalesce("a", F.lit(0)).alias("a")).collect()) == [(False, 1), (False, 2), (True, 0)]


# ---- state


def _followed(events, mark, threshold=5, pause=300):
    """A breaker by its definition: events are (key, event_id, second), taken up to the watermark."""
    out = []
    for key in {e[0] for e in events}:
        failures, is_open, reset = 0, False, 0
        for second, event in sorted((s, e) for k, e, s in events if k == key and s <= mark):
            if is_open and second > reset:
                out.append((key, None, 0, False))
                failures, is_open = 0, False
            failures += 1
            if failures >= threshold:
                is_open, reset = True, second + pause
            out.append((key, event, failures, is_open))
        if is_open and reset < mark:
            out.append((key, None, 0, False))
    return sorted(out, key=str)


def test_breaker_does_not_depend_on_batches_and_closes_by_itself(spark):
    import random

    rnd = random.Random(4)
    times = [(rnd.randrange(3), 10 * rnd.randrange(200)) for _ in range(60)] + [(7, 20 * k) for k in range(5)] + [(9, 2000)]
    events = [(key, n, s) for n, (key, s) in enumerate(times)]
    # out of order by less than the delay, in different cuts
    order = sorted(events, key=lambda e: e[2] + rnd.randrange(250))
    schema, want = "user_id long, event_id long, ts timestamp", _followed(events, 2000 - 600)
    assert (7, None, 0, False) in want
    for cuts in (1, 3):
        path = scratch_path(spark, "t-cuts")
        step = -(-len(order) // cuts)
        for c in range(cuts):
            part = [(k, e, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)) for k, e, s in order[c * step : (c + 1) * step]]
            _write(spark, part, schema, path, f"{c}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(path)
        made = jobs.drain(jobs.circuit_breaker(stream, "user_id"), "t-cuts-out", settings=jobs.ROCKSDB)
        got = sorted(((r.key, r.event_id, r.failures, r.open) for r in made.collect()), key=str)
        assert got == want


def test_a_key_that_returns_after_the_delay_is_new_and_late_rows_are_counted(spark):
    path, schema = scratch_path(spark, "t-expire"), "digest string, ts timestamp"
    _write(spark, [("x", at(0)), ("y", at(1))], schema, path, "a")
    _write(spark, [("x", at(20)), ("z", at(200))], schema, path, "b")
    # the watermark that drops rows and state in a batch is that of the batch before
    _write(spark, [("w", at(201))], schema, path, "c")
    _write(spark, [("x", at(210)), ("late", at(5))], schema, path, "d")
    _write(spark, [("x", at(215))], schema, path, "e")
    progress = []
    made = jobs.drain(jobs.first_arrivals(_stream(spark, path, schema), ["digest"], "ts", "1 hour"), "t-expire-out", settings=jobs.ROCKSDB, progress=progress)
    assert sorted((r.digest, r.ts) for r in made.collect()) == [("w", at(201)), ("x", at(0)), ("x", at(210)), ("y", at(1)), ("z", at(200))]
    assert jobs.late_rows(progress) == 1


def test_upsert_log_stays_small_and_repeats_change_nothing(spark):
    from loomset.streaming.upserts import UpsertLog

    path, want = scratch_path(spark, "t-log"), {}
    log = UpsertLog(spark, path, ["run"], ["ts"], compact_every=4)
    with pytest.raises(FileNotFoundError):
        log.read()
    for number in range(23):
        rows = [(k, number * 10 - (k == 3) * 500, float(number + k)) for k in (number % 5, 3)]
        for run, ts, metric in rows:
            if run not in want or ts > want[run][0]:
                want[run] = (ts, metric)
        batch = spark.createDataFrame(rows, "run long, ts long, metric double").coalesce(1)
        log.append(batch, number)
        if number % 6 == 0:
            before = log.manifest()
            log.append(batch.withColumn("metric", F.lit(-1.0)), number)
            assert log.manifest() == before
    got = {r.run: (r.ts, r.metric) for r in UpsertLog(spark, path, ["run"], ["ts"]).read().collect()}
    assert got == want
    assert len(log._names("data")) <= 11 and len([n for n in log._names("manifests") if n.endswith(".json")]) <= 2
    # a batch that failed before its manifest is listed nowhere and cleared away later
    spark.range(1).write.parquet(f"{path}/data/delta-orphan")
    log.append(spark.createDataFrame([(1, 10_000, 1.0)], "run long, ts long, metric double"), 23)
    assert "delta-orphan" not in log._names("data")
    assert log.read().where("run = 1").first().ts == 10_000


@pytest.mark.parametrize("files", [0, 1, 3])
def test_a_table_is_a_file_or_a_folder_of_files(spark, tmp_path, files):
    rows, path = spark.range(30), tmp_path / "numbers.parquet"
    rows.repartition(max(files, 1)).write.parquet(str(path if files else tmp_path / "made"))
    if not files:
        next((tmp_path / "made").glob("part-*.parquet")).rename(path)
    spark.range(5).write.parquet(str(tmp_path / "other.parquet"))
    made = jobs.drain(jobs.file_stream(spark, str(tmp_path), "numbers.parquet", rows.schema), "t-files-out")
    assert sorted(r.id for r in made.collect()) == list(range(30))


def test_breaker_asks_for_little_state():
    import pandas as pd

    from loomset.streaming.jobs import Breaker

    calls = []

    class Held:
        def __init__(self, value=None):
            self.value = value

        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name in ("put", "appendList"):
                    self.value = ([] if name == "put" else list(self.value or [])) + list(args[0])
                elif name == "update":
                    self.value = args[0]
                elif name == "clear":
                    self.value = None
                elif name == "exists":
                    return self.value is not None
                elif name in ("get", "listTimers"):
                    return iter(self.value or []) if self.many or name == "listTimers" else self.value
            return call

    class Mark:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    breaker = Breaker(2, 5_000_000)
    breaker.handle, breaker.state, breaker.waiting = Held(), Held(), Held()
    breaker.handle.many = breaker.waiting.many = True
    breaker.state.many = False
    rows = pd.DataFrame({"event_id": [2, 1], "ts": pd.to_datetime([2, 1], unit="s")})
    assert not list(breaker.handleInputRows((7,), iter([rows]), Mark(0)))
    assert calls == ["get", "get", "appendList", "registerTimer"]
    made = pd.concat(breaker.handleExpiredTimer((7,), Mark(3000), None))
    assert made["event_id"].tolist() == [1, 2] and made["open"].tolist() == [False, True] and breaker.waiting.value is None
    made = pd.concat(breaker.handleExpiredTimer((7,), Mark(9000), None))
    assert made["failures"].tolist() == [0] and breaker.state.value == (0, False, 7_000_000)
