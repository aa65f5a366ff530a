"""Streams against batches on the same rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assaylake import Reference, Rule, RuleError, Run, run_rules
from assaylake.streaming import running, validate

SCHEMA = "id int, at timestamp, kind string, value int"
RULES = [
    Rule("a", "range", "value", {"min": 1, "max": 5}, enforcement="hard"),
    Rule("b", "allowed_values", "kind", {"values": ["x"]}),
]


def rows(n):
    return [(i, f"2026-01-01 0{i // 10}:{i % 10}0:00" if i % 10 < 6 else f"2026-01-01 0{i // 10}:59:00", "xy"[i % 2], i % 7) for i in range(n)]


@pytest.fixture()
def feed(spark, tmp_path):
    df = spark.createDataFrame([(a, b, c, d) for a, b, c, d in rows(40)], "id int, at string, kind string, value int")
    df = df.withColumn("at", F.col("at").cast("timestamp"))
    path = str(tmp_path / "feed")
    df.repartition(4).write.parquet(path)
    return df, path


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_row_rules_equal_batch(spark, feed, tmp_path):
    df, path = feed
    refs = {"r": Reference(spark.createDataFrame([(2,), (3,)], "v int"))}
    rules = [*RULES, Rule("c", "referential_integrity", "value", {"ref_table": "r", "ref_column": "v"})]
    checked = validate.stream_validated(stream(spark, path), rules, "2026-02-01 00:00:00", refs)
    validate.append_to(checked, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.schema(checked.schema).parquet(str(tmp_path / "out"))
    want = run_rules(df, rules, Run("r", "d", "2026-02-01 00:00:00"), refs).validated
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_route_and_replay(spark, feed, tmp_path):
    df, path = feed
    checked = validate.stream_validated(stream(spark, path), RULES, "2026-02-01 00:00:00")
    clean, held = (validate.batch_folder(str(tmp_path / n)) for n in ("clean", "held"))
    validate.route(checked, clean, held, str(tmp_path / "ck")).awaitTermination()
    good = df.where("value BETWEEN 1 AND 5").count()
    assert spark.read.parquet(str(tmp_path / "clean")).count() == good
    assert spark.read.parquet(str(tmp_path / "held")).count() == 40 - good
    # A replayed batch replaces its own output.
    again = spark.read.parquet(str(tmp_path / "clean") + "/batch=0").collect()
    clean(spark.createDataFrame(again), 0)
    assert spark.read.parquet(str(tmp_path / "clean")).count() == good


def test_uniqueness_is_refused_without_a_window(spark, feed):
    _, path = feed
    with pytest.raises(RuleError):
        validate.stream_verdicts(stream(spark, path), [Rule("u", "uniqueness", "id")])


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    path = str(tmp_path / "late")
    # Spark judges lateness by the watermark of the batch before, so the late row comes two batches after.
    batches = [[(1, "2026-01-01 00:10:00", "x", 1)], [(2, "2026-01-01 05:00:00", "x", 1)], [(5, "2026-01-01 05:10:00", "x", 1)], [(3, "2026-01-01 00:20:00", "x", 1)], [(4, "2026-01-01 09:00:00", "x", 1)]]
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "id int, at string, kind string, value int").withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(path)
        import time

        time.sleep(1.1)  # the file source orders files by modification time
    source = stream(spark, path)
    metrics = validate.window_metrics(source, RULES, time="at", delay="1 hour", window=F.window("at", "1 hour"))
    validate.append_to(metrics, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.schema(metrics.schema).parquet(str(tmp_path / "out"))
    first = got.where("window_start = '2026-01-01 00:00:00' AND rule_id = 'a'").collect()
    assert [(r.total, r.passed) for r in first] == [(1, 1)]  # row 3 came too late
    batch = validate.window_metrics(spark.read.schema(SCHEMA).parquet(path), RULES, time="at", delay="1 hour", window=F.window("at", "1 hour"))
    assert batch.where("window_start = '2026-01-01 00:00:00' AND rule_id = 'a'").first().total == 2


def test_duplicates_and_first_seen(spark, feed, tmp_path):
    df, path = feed
    seen = validate.first_seen(stream(spark, path), ["kind", "value"], time="at", delay="2 days")
    validate.append_to(seen, str(tmp_path / "seen"), str(tmp_path / "ck1")).awaitTermination()
    got = spark.read.schema(SCHEMA).parquet(str(tmp_path / "seen"))
    assert got.count() == df.select("kind", "value").distinct().count()
    batch = validate.windowed_duplicates(df, ["kind"], time="at", delay="1 hour", size="1 hour")
    assert all(r.n > 1 for r in batch.collect()) and batch.count() == 8


def test_window_metrics_refuse_what_they_cannot_judge(spark, feed):
    df, _ = feed
    for rule in (Rule("u", "uniqueness", "id"), Rule("e", "not_null", "gone")):
        with pytest.raises(RuleError, match=rule.rule_id):
            validate.window_metrics(df, [*RULES, rule], time="at", delay="1 hour", window=F.window("at", "1 hour"))


@pytest.mark.parametrize("limit", [500_000, -1])
def test_references_compare_text_and_numbers_as_a_batch_does(spark, feed, monkeypatch, limit):
    df, _ = feed
    monkeypatch.setattr(validate, "BROADCAST_KEYS", limit)
    refs = {"r": Reference(spark.createDataFrame([("2",), ("x",), (None,)], "v string"))}
    rule = Rule("c", "referential_integrity", "value", {"ref_table": "r", "ref_column": "v"})
    got = validate.stream_verdicts(df.withColumn("value", F.nullif("value", F.lit(3))), [rule], refs=refs).frame
    assert got.where("__v0").count() == df.where("value = 2").count() and got.count() == df.count()


# --- running metrics ---------------------------------------------------------------------------------------

START = dt.datetime(2026, 1, 1)


def brute_sessions(visits, gap):
    """visits: (user, seconds); sessions as (user, first, last, rows)."""
    out, by = [], defaultdict(list)
    for user, at in visits:
        if at is not None:
            by[user].append(at)
    for user, times in by.items():
        times.sort()
        first, last, n = times[0], times[0], 0
        for at in times:
            if at - last >= gap:
                out.append((user, first, last, n))
                first, n = at, 0
            last, n = at, n + 1
        out.append((user, first, last, n))
    return sorted(out, key=str)


def visits_frame(spark, visits):
    rows = [(u, None if at is None else START + dt.timedelta(seconds=at)) for u, at in visits]
    return spark.createDataFrame(rows, "user string, at timestamp").repartition(5)


def seconds(found):
    second = lambda t: round((t - START).total_seconds())
    return sorted(((r.user, second(r.window_start), second(r.window_end) - 60, r.total) for r in found.collect()), key=str)


@pytest.mark.parametrize("bucket", [1, 2, 3, 1024])
def test_sessions_join_across_buckets(spark, bucket):
    made = random.Random(4)
    visits = [(None, 5), ("quiet", None), ("once", 7), ("edge", 0), ("edge", 60), ("edge", 119), ("edge", 179)]
    at = -40_000
    for _ in range(1500):  # one user with most of the rows, in stretches far longer than a bucket
        at += made.choice([0, 1, 20, 59, 59, 59, 60, 61, 400])
        visits.append(("hot", at))
    visits += [(f"u{made.randrange(30)}", made.randrange(9000)) for _ in range(600)]
    slots = running.slot_partial("at", "60 seconds", ["user"], [F.count(F.lit(1)).alias("total")])(visits_frame(spark, visits), F.lit(None).cast("timestamp"))
    assert slots.where("user = 'hot'").count() < 1500
    assert seconds(running.sessions(slots, ["user"], "60 seconds", bucket)) == brute_sessions(visits, 60)


def test_no_task_of_a_session_holds_a_users_rows(spark):
    """A user with all rows: what is shuffled are slots, of which a task before the shuffle has at most a few."""
    visits = [("hot", k % 300) for k in range(20_000)]
    slots = running.slot_partial("at", "60 seconds", ["user"], [F.count(F.lit(1)).alias("total")])(visits_frame(spark, visits), F.lit(None).cast("timestamp"))
    assert slots.count() == 5 and seconds(running.sessions(slots, ["user"], "60 seconds")) == [("hot", 0, 299, 20_000)]
    plan = slots._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "partial_count" in plan


def arrivals(spark, folder, batches):
    for k, rows in enumerate(batches):
        visits_frame(spark, rows).coalesce(1).write.parquet(f"{folder}/part={k}")
        yield spark.readStream.schema("user string, at timestamp").parquet(folder)


def test_open_windows_and_late_rows(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[("a", 10), ("a", 4000)], [("a", 3500), ("b", 9000), ("c", None)], [("a", 20), ("a", 5300), ("a", 9001)], []]
    window = running.window_partial(F.window("at", "1 hour"), "at", ["user"], [F.count(F.lit(1)).alias("total")])
    for stream_ in arrivals(spark, folder, batches):
        running.follow(stream_, window, delay="10 minutes", path=path, checkpoint=str(tmp_path / "ck")).awaitTermination()
    read = lambda late: sorted((r.user, round((r.window_start - START).total_seconds()), r.total) for r in running.window_totals(running.stored(spark, path, late), ["user"]).collect())
    # before the second batch the watermark is 4000 - 600: nothing is late; before the third it is 9000 - 600
    assert read(False) == [("a", 0, 2), ("a", 3600, 1), ("a", 7200, 1), ("b", 7200, 1)]
    assert read(True) == [("a", 0, 1), ("a", 3600, 1)]
    # a batch that is replayed judges and counts as before
    before = sorted(map(str, running.stored(spark, path).collect()))
    offsets = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for file in (offsets[-1], offsets[-1].with_name(f".{offsets[-1].name}.crc")):
        file.unlink()
    again = spark.readStream.schema("user string, at timestamp").parquet(folder)
    running.follow(again, window, delay="10 minutes", path=path, checkpoint=str(tmp_path / "ck")).awaitTermination()
    assert sorted(map(str, running.stored(spark, path).collect())) == before


def test_batches_of_a_stream_isolate_rules(spark, feed, tmp_path):
    df, path = feed
    refs = {"r": Reference(spark.createDataFrame([(2,), (3,)], "v int"))}
    rules = [
        *RULES,
        Rule("c", "referential_integrity", "value", {"ref_table": "r", "ref_column": "v"}),
        Rule("bad", "custom_sql", "kind", {"sql_expression": "cast(kind as int) > 0"}, enforcement="hard"),
    ]
    sinks = {n: validate.batch_folder(str(tmp_path / n)) for n in ("clean", "quarantine", "log", "score", "validated")}
    source = stream(spark, path)
    running.judge_batches(source, rules, Run("s", "d", "2026-02-01 00:00:00"), sinks, str(tmp_path / "ck"), refs).awaitTermination()
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    want = run_rules(df, rules[:3], Run("r", "d"), refs)
    assert read("clean").count() == want.clean.count() and read("quarantine").count() == want.quarantine.count()
    log = defaultdict(list)
    for r in read("log").collect():
        log[r.rule_id].append(r)
    batches = len(log["a"])
    assert batches > 1 and all(r.status == "error" and r.passed_count == 0 for r in log["bad"]) and len(log["bad"]) == batches
    assert sum(r.passed_count for r in log["c"]) == df.where("value IN (2, 3)").count()
    assert read("score").agg(F.sum("total_records_in")).first()[0] == 40
    with pytest.raises(RuleError):
        running.judge_batches(source, [Rule("u", "uniqueness", "id")], Run("s", "d"), sinks, str(tmp_path / "no"))


def test_window_metrics_tell_rules_that_cannot_be_evaluated(spark, feed):
    df, _ = feed
    rules = [RULES[0], Rule("bad", "custom_sql", "kind", {"sql_expression": "if(kind = 'y', cast(kind as int), value) > 3"})]
    found = validate.window_metrics(df, rules, time="at", delay="1 hour", window=F.window("at", "1 hour"), by=["kind"]).collect()
    assert {(r.rule_id, r.kind, r.passed is None, r.errors > 0) for r in found} == {("a", "x", False, False), ("a", "y", False, False), ("bad", "x", False, False), ("bad", "y", True, True)}
    assert all((r.clean is None) == (r.kind == "y") for r in found)
