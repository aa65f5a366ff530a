"""Edge cases of rule types, keys, skew and error isolation."""

import pytest
from pyspark.sql import functions as F

import assaylake
from assaylake import Reference, Rule, RuleError, Run, compile_rules, register_rule_type, run_rules
from assaylake.plans import keyed
from assaylake.plans.compile import expectations
from assaylake.plans.metrics import execution_log, rule_counts, tally
from assaylake.plans.verdicts import evaluate


def passes(df, *rules, refs=None, as_of=None, key="id"):
    """{rule position: {key: passed}}"""
    v = evaluate(df, compile_rules(df, rules, refs, as_of))
    rows = v.frame.select(key, *[v.passed(i).alias(f"p{i}") for i in range(len(v.rules))]).collect()
    return [{r[key]: r[f"p{i}"] for r in rows} for i in range(len(v.rules))]


def counts(df, *rules, refs=None, as_of=None):
    return {
        r.rule_id: (r.total_records, r.passed_count, r.error_message)
        for r in rule_counts(df, compile_rules(df, rules, refs, as_of)).collect()
    }


def test_null_fails_every_row_rule(spark):
    df = spark.createDataFrame([(1, None, None, None)], "id int, n int, s string, t timestamp")
    refs = {"r": Reference(spark.createDataFrame([(1,)], "k int"))}
    rules = [
        Rule("a", "not_null", "n"),
        Rule("b", "range", "n", {"min": 0, "max": 9}),
        Rule("c", "regex", "s", {"pattern": "."}),
        Rule("d", "allowed_values", "s", {"values": ["x"]}),
        Rule("e", "length", "s", {"min_length": 0, "max_length": 9}),
        Rule("f", "freshness", "t", {"max_age_hours": 1}),
        Rule("g", "custom_sql", "n", {"sql_expression": "n > 0"}),
        Rule("h", "referential_integrity", "n", {"ref_table": "r", "ref_column": "k"}),
    ]
    assert [p[1] for p in passes(df, *rules, refs=refs)] == [False] * len(rules)
    assert all(c[:2] == (1, 0) for c in counts(df, *rules, refs=refs).values())


def test_null_keys_of_uniqueness(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "id int, k string")
    ignored, equal = passes(df, Rule("a", "uniqueness", "k"), Rule("b", "uniqueness", "k", {"nulls": "equal"}))
    assert ignored == {1: True, 2: True, 3: False, 4: False, 5: True}
    assert equal == {1: False, 2: False, 3: False, 4: False, 5: True}
    assert counts(df, Rule("a", "uniqueness", "k"))["a"][:2] == (5, 3)
    assert counts(df, Rule("b", "uniqueness", "k", {"nulls": "equal"}))["b"][:2] == (5, 1)


def test_hard_rule_keeps_exact_duplicates_of_good_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, s string")
    for mode in ("row", "sequential"):
        result = run_rules(df, [Rule("a", "not_null", "s", enforcement="hard")], Run("r", "d"), mode=mode)
        assert [tuple(r) for r in result.clean.collect()] == [(1, "a"), (1, "a")]


def test_patterns_are_native(spark):
    df = spark.createDataFrame([(1, "a@bxcom"), (2, "a@b.com"), (3, "sams")], "id int, s string")
    dot, space = passes(
        df, Rule("a", "regex", "s", {"pattern": r"^a@b\.com$"}), Rule("b", "regex", "s", {"pattern": r"^[^\s].*[^\s]$"})
    )
    assert dot == {1: False, 2: True, 3: False} and space[3]


def test_allowed_values_quotes_and_numbers(spark):
    df = spark.createDataFrame([(1, "O'Neil", 1), (2, "x", 3)], "id int, s string, n int")
    quoted, number = passes(
        df, Rule("a", "allowed_values", "s", {"values": ["O'Neil"]}), Rule("b", "allowed_values", "n", {"values": [1, 2]})
    )
    assert quoted == {1: True, 2: False} and number == {1: True, 2: False}


@pytest.mark.parametrize("longer", [0, 6_000])
def test_value_lists_compare_alike_at_any_length(spark, longer):
    rows = [(1, "1.0", "2024-01-01", "1.50"), (2, "01", "2024-01-02", "1.51"), (3, "2", None, None), (4, None, None, "2.00")]
    df = spark.createDataFrame(rows, "id int, s string, d string, c string")
    df = df.withColumn("d", F.col("d").cast("timestamp")).withColumn("c", F.col("c").cast("decimal(10,2)"))
    numbers = list(range(1_000, 1_000 + longer))
    texts = [f"2100-01-01 00:00:{k % 60:02d}.{k:06d}" for k in range(longer)]
    rules = [
        Rule("a", "allowed_values", "s", {"values": [1, 2, *numbers]}),
        Rule("b", "allowed_values", "d", {"values": ["2024-01-01", *texts]}),
        Rule("c", "allowed_values", "c", {"values": ["1.5", *map(str, numbers)]}),
        Rule("d", "allowed_values", "id", {"values": [1, 4, *numbers]}),
    ]
    checks = compile_rules(df, rules)
    assert [c.kind for c in checks] == ["row"] * 4 and len(expectations(checks)) == 4
    number, time, decimal, whole = passes(df, *rules)
    assert number == {1: True, 2: True, 3: True, 4: False} and time == {1: True, 2: False, 3: False, 4: False}
    assert decimal == {1: True, 2: False, 3: False, 4: False} and whole == {1: True, 2: False, 3: False, 4: True}


def test_parameters_must_be_lists(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    checks = compile_rules(df, [Rule("a", "allowed_values", "s", {"values": "abc"}), Rule("b", "uniqueness", "s", {"columns": "i"})])
    assert [c.kind for c in checks] == ["error", "error"]


def test_rules_that_fail_on_rows_become_errors(spark):
    df = spark.createDataFrame([(1, "a"), (2, "7"), (3, None)], "i int, s string")
    rules = [
        Rule("ok", "range", "i", {"min": 2}, enforcement="hard"),
        Rule("pattern", "regex", "s", {"pattern": "[a-"}),
        Rule("values", "allowed_values", "i", {"values": ["x", "1"]}),
        Rule("bound", "range", "i", {"min": "abc"}),
        Rule("cast", "custom_sql", "s", {"sql_expression": "cast(s as int) > 0"}),
        Rule("zero", "custom_sql", "i", {"sql_expression": "1 / (i - 1) > 0"}),
        Rule("year", "custom_sql", "i", {"sql_expression": "extract(year from (timestamp'2024-01-01')) = 2024"}),
        Rule("sub", "custom_sql", "i", {"sql_expression": "i > (select 0)"}),
        Rule("good", "custom_sql", "s", {"sql_expression": "try_cast(s as int) > 0"}),
    ]
    for mode in ("row", "sequential"):
        log = {r.rule_id: (r.status, r.passed_count) for r in run_rules(df, rules, Run("r", "d"), mode=mode).log.collect()}
        assert {k for k, v in log.items() if v[0] == "error"} == {"pattern", "values", "bound", "cast", "zero", "sub"}
        assert log["ok"] == ("failed", 2) and log["good"][1] == 1 and log["year"][0] == "passed"


def jobs_of(spark, work):
    """The result of work, and the number of jobs that it started."""
    spark.sparkContext.setJobGroup("counted", "counted")
    out = work()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setJobGroup("others", "others")
    return out, len(jobs)


SHARED = [
    Rule("cast", "custom_sql", "s", {"sql_expression": "cast(s as int) > 5"}),
    Rule("cast-again", "custom_sql", "s", {"sql_expression": "cast(s as int) < 90"}),
    Rule("sometimes", "custom_sql", "s", {"sql_expression": "case when id < 50 then true else cast(s as int) > 0 end"}),
    Rule("ok", "custom_sql", "s", {"sql_expression": "length(s) > 1"}, enforcement="hard"),
    Rule("low", "range", "id", {"min": 10}),
]


def test_rules_by_users_share_what_fails(spark, tmp_path):
    """Several rules with one failing part: it is evaluated inside each rule, not taken out in front of them."""
    path = str(tmp_path / "rows")
    spark.range(100).select("id", F.when(F.col("id") % 10 == 3, "x").otherwise(F.col("id").cast("string")).alias("s")).write.parquet(path)
    df = spark.read.parquet(path)
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.codegen.wholeStage", mode)
        try:
            want = {"cast": ("error", 0), "cast-again": ("error", 0), "sometimes": ("error", 0), "ok": ("failed", 81), "low": ("failed", 90)}
            counted = rule_counts(df, compile_rules(df, SHARED))
            log = {r.rule_id: (r.status, r.passed_count) for r in execution_log(counted, Run("r", "d")).collect()}
            assert log == want
            messages = {r.rule_id: r.error_message for r in counted.collect()}
            assert messages["cast"] == "cannot be evaluated on 10 rows" and messages["sometimes"] == "cannot be evaluated on 5 rows"
            for how in ("row", "sequential"):
                result = run_rules(df, SHARED, Run("r", "d"), mode=how)
                status = {k: v[0] for k, v in want.items()} | ({"low": "passed"} if how == "sequential" else {})  # hidden from it
                assert {r.rule_id: r.status for r in result.log.collect()} == status
                assert result.validated.first()["_dq"]["total_rules"] == 2
                assert result.clean.count() == 81 and result.score.first().rules_errored == 3
        finally:
            spark.conf.unset("spark.sql.codegen.wholeStage")


def test_compiling_reads_no_row(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).select("id", F.col("id").cast("string").alias("s")).write.parquet(path)
    df = spark.read.parquet(path)
    checks, jobs = jobs_of(spark, lambda: compile_rules(df, SHARED))
    assert jobs == 0 and [c.kind for c in checks] == ["row"] * 5
    # log and score read the stored counters, not the rows
    result = run_rules(df, SHARED, Run("r", "d"))
    assert all("tally" in f for n in (result.log, result.score) for f in n.inputFiles())


def test_shuffled_key_rules_read_their_source_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(keyed, "HOT_ROWS", 1_000)
    path = str(tmp_path / "skewed")
    skewed(spark).write.parquet(path)
    df = spark.read.parquet(path)
    refs = {"r": Reference(spark.range(0, 250).select(F.col("id").alias("k")))}
    frame = run_rules(df, KEY_RULES, Run("r", "d"), refs).verdicts.frame
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") - plan.count("Relation [__") == 1 and "Union" not in plan


def test_long_hot_keys_stay_out_of_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(keyed, "HOT_ROWS", 100)
    df = spark.range(400).select("id", F.when(F.col("id") < 300, F.repeat(F.lit("x"), 5_000)).otherwise(F.col("id").cast("string")).alias("s"))
    rule = Rule("u", "uniqueness", "s")
    (check,) = compile_rules(df, [rule])
    found = keyed.bad_keys(df, check)
    assert keyed._mark_hot(df, found).where("__aside").count() == 300
    assert max(len(r["__k0"]) for r in found.hot.collect()) == 5_000
    assert sum(passes(df, rule)[0].values()) == 100


def test_freshness_is_exact(spark):
    rows = [(1, "2026-03-31 00:00:00"), (2, "2026-03-30 23:01:00"), (3, "not a time")]
    df = spark.createDataFrame(rows, "id int, s string")
    rule = Rule("a", "freshness", "s", {"max_age_hours": 24})
    assert passes(df, rule, as_of="2026-04-01 00:00:00")[0] == {1: True, 2: False, 3: False}
    typed = df.withColumn("s", F.col("s").try_cast("timestamp"))
    assert passes(typed, rule, as_of="2026-04-01 00:00:00")[0] == {1: True, 2: False, 3: False}


def test_bounds(spark):
    df = spark.createDataFrame([(1, 5, "7", "2026-01-01"), (2, 15, "x", "2026-02-01")], "id int, n int, s string, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    low, text, day = passes(
        df,
        Rule("a", "range", "n", {"min": 10}),
        Rule("b", "range", "s", {"min": 1, "max": 9}),
        Rule("c", "range", "d", {"max": "2026-01-15"}),
    )
    assert (low, text, day) == ({1: False, 2: True}, {1: True, 2: False}, {1: True, 2: False})


def test_bad_rules_become_errors_and_leave_others_alone(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    rules = [
        Rule("ok", "not_null", "s"),
        Rule("column", "not_null", "gone"),
        Rule("type", "median_check", "s"),
        Rule("bounds", "range", "id", {}),
        Rule("pattern", "regex", "s", {}),
        Rule("list", "allowed_values", "s", {"values": []}),
        Rule("age", "freshness", "s", {}),
        Rule("reference", "referential_integrity", "s", {"ref_table": "nowhere", "ref_column": "k"}),
        Rule("syntax", "custom_sql", "s", {"sql_expression": "s >>> !"}),
        Rule("unknown", "custom_sql", "s", {"sql_expression": "nothing = 1"}),
        Rule("aggregate", "custom_sql", "s", {"sql_expression": "sum(id) > 0"}),
        Rule("subquery", "custom_sql", "s", {"sql_expression": "id IN (SELECT 1)"}),
        Rule("random", "custom_sql", "s", {"sql_expression": "rand() > 0.5"}),
        Rule("scope", "uniqueness", "s", {"scope": "galaxy"}),
    ]
    result = run_rules(df, rules, Run("r", "d"))
    log = {r.rule_id: (r.status, r.dq_score) for r in result.log.collect()}
    assert log.pop("ok") == ("passed", 100.0)
    assert set(log.values()) == {("error", None)} and len(log) == len(rules) - 1
    row = result.validated.first()["_dq"]
    assert row["total_rules"] == 1 and row["all_passed"]
    score = result.score.first()
    assert (score.rules_errored, score.overall_dq_score) == (len(rules) - 1, 100.0)


def test_word_select_in_a_literal_is_no_subquery(spark):
    df = spark.createDataFrame([(1, "select")], "id int, s string")
    assert passes(df, Rule("a", "custom_sql", "s", {"sql_expression": "s = 'select'"}))[0] == {1: True}


def test_two_references_on_one_column(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string")
    refs = {
        "one": Reference(spark.createDataFrame([("x",), ("x",), (None,)], "k string")),
        "two": Reference(spark.createDataFrame([("y",)], "k string")),
    }
    one, two = passes(
        df,
        Rule("a", "referential_integrity", "k", {"ref_table": "one", "ref_column": "k"}),
        Rule("b", "referential_integrity", "k", {"ref_table": "two", "ref_column": "k"}),
        refs=refs,
    )
    assert one == {1: True, 2: False} and two == {1: False, 2: True}


def test_reference_between_text_and_numbers(spark):
    df = spark.createDataFrame([(1, "7"), (2, "no number")], "id int, k string")
    refs = {"r": Reference(spark.createDataFrame([(7,)], "k int"))}
    rule = Rule("a", "referential_integrity", "k", {"ref_table": "r", "ref_column": "k"})
    assert passes(df, rule, refs=refs)[0] == {1: True, 2: False}


def test_custom_rule_type(spark):
    register_rule_type("even", lambda params, column: column % 2 == params.get("rest", 0))
    df = spark.range(4)
    assert passes(df, Rule("a", "even", "id"))[0] == {0: True, 1: False, 2: True, 3: False}
    assert "even" in assaylake.rule_types()


def skewed(spark):
    """A third of the rows share a key, another third has none."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 500).cast("int")
    return spark.range(0, 30_000, 1, 8).select("id", key.alias("k"), (F.col("id") % 11).alias("m"))


KEY_RULES = [
    Rule("u", "uniqueness", "k"),
    Rule("n", "uniqueness", "k", {"nulls": "equal"}),
    Rule("c", "uniqueness", "k", {"columns": ["k", "m"]}),
    Rule("r", "referential_integrity", "k", {"ref_table": "r", "ref_column": "k"}),
]


def test_shuffled_key_verdicts_equal_broadcast_ones(spark, monkeypatch):
    df = skewed(spark)
    refs = {"r": Reference(spark.range(0, 250).select(F.col("id").alias("k")))}
    broadcast = passes(df, *KEY_RULES, refs=refs)
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(keyed, "HOT_ROWS", 1_000)
    assert passes(df, *KEY_RULES, refs=refs) == broadcast
    # The light counts agree with the joined verdicts.
    light = counts(df, *KEY_RULES, refs=refs)
    for rule, verdicts in zip(KEY_RULES, broadcast):
        assert light[rule.rule_id][:2] == (30_000, sum(verdicts.values()))


def test_hot_and_null_keys_stay_out_of_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(keyed, "HOT_ROWS", 1_000)
    df = skewed(spark)
    (check,) = compile_rules(df, KEY_RULES[:1])
    found = keyed.bad_keys(df, check)
    assert not found.broadcast
    marked = keyed._mark_hot(df, found)
    assert marked.where("__aside").count() == df.where("k = 0 OR k IS NULL").count() > 20_000
    rest = marked.where("NOT __aside").groupBy("k").count()
    assert rest.where("count >= 1000 OR k IS NULL").count() == 0
    assert keyed.attach_key_verdict(df, found, "ok").count() == df.count()


def test_hot_good_reference_keys_stay_out_of_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(keyed, "HOT_ROWS", 1_000)
    df = skewed(spark)
    (check,) = compile_rules(df, KEY_RULES[3:], {"r": Reference(spark.createDataFrame([(0,)], "k int"))})
    marked = keyed._mark_hot(df, keyed.bad_keys(df, check))
    assert marked.where("__aside AND k = 0 AND NOT __hot_bad").count() == df.where("k = 0").count()


def test_brute_force(spark):
    """Random rows against plain Python, in both modes."""
    import random

    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, *range(12)]), rnd.choice([None, "a", "b", "cc"])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, n int, s string").repartition(5)
    rules = [
        Rule("1", "range", "n", {"min": 1, "max": 9}, enforcement="hard"),
        Rule("2", "uniqueness", "n", {"columns": ["n", "s"]}, enforcement="hard"),
        Rule("3", "length", "s", {"max_length": 1}, enforcement="soft"),
        Rule("4", "uniqueness", "s", enforcement="soft"),
        Rule("5", "allowed_values", "s", {"values": ["a", "cc"]}, enforcement="hard"),
        Rule("6", "uniqueness", "n", enforcement="hard"),
    ]

    def check(rule, row, among):
        _, n, s = row
        if rule.rule_id == "1":
            return n is not None and 1 <= n <= 9
        if rule.rule_id == "3":
            return s is not None and len(s) <= 1
        if rule.rule_id == "5":
            return s in ("a", "cc")
        key = {"2": lambda r: (r[1], r[2]), "4": lambda r: (r[2],), "6": lambda r: (r[1],)}[rule.rule_id]
        return None in key(row) or sum(key(r) == key(row) for r in among) == 1

    for mode in ("row", "sequential"):
        alive, want = list(rows), {}
        for rule in rules:
            ok = {r for r in alive if check(rule, r, alive)}
            want[rule.rule_id] = (len(alive), len(ok))
            if mode == "sequential" and rule.hard:
                alive = [r for r in alive if r in ok]
        if mode == "row":
            alive = [r for r in rows if all(check(x, r, rows) for x in rules if x.hard)]
        result = run_rules(df, rules, Run("r", "d"), mode=mode)
        got = {r.rule_id: (r.total_records, r.passed_count) for r in result.log.collect()}
        assert got == want, mode
        assert sorted(r.id for r in result.clean.collect()) == sorted(r[0] for r in alive)


def test_sequential_without_hard_rules_is_row_mode(tables, rules, refs):
    from dataclasses import replace

    from tests import fixture_data as fx

    soft = [replace(r, enforcement="soft") for r in rules["customers"]]
    logs = [
        sorted((r.rule_id, r.total_records, r.passed_count) for r in run_rules(tables["customers"], soft, Run("r", "c", fx.AS_OF), refs, m).log.collect())
        for m in ("row", "sequential")
    ]
    assert logs[0] == logs[1]


def test_many_rules_in_one_plan(spark):
    from assaylake.operators import datagen, rulebook

    df = datagen.transactions(spark, 500, 50, "2026-04-01")
    columns = {"transactions": {"string": ["transaction_id", "customer_id", "merchant"], "numeric": ["amount", "quantity"]}}
    many = rulebook.to_rules(rulebook.generate_rules(spark, columns, 300))
    result = run_rules(df, many, Run("r", "transactions"))
    assert len(many) == 300 and {r.status for r in result.log.collect()} <= {"passed", "failed"}
    total = result.score.first()
    assert total.total_rules == 300 and total.total_records_in == 500
    row = result.validated.first()["_dq"]
    assert row["passed_count"] + row["failed_count"] == len(row["results"]) == 300


def test_rows_are_judged_by_the_version_of_their_time(spark):
    from assaylake.plans.versions import RuleVersion, annotate_versions, version_counts, versions_from

    rows = [(k, None if k == 12 else f"2026-01-{k + 1:02d}", k * 10, "x" if k == 4 else str(k)) for k in range(13)]
    df = spark.createDataFrame(rows, "id int, day string, n int, s string").withColumn("day", F.col("day").cast("date"))
    rule = lambda high: Rule("a", "range", "n", {"max": high})
    history = [
        RuleVersion(rule(1000), 3, "2026-01-09"),
        RuleVersion(rule(15), 1, None, "2026-01-04"),  # over on the 4th, its successor begins on the 6th
        RuleVersion(rule(65), 2, "2026-01-06", "2026-02-01"),
        RuleVersion(Rule("b", "custom_sql", "s", {"sql_expression": "cast(s as int) > 6"}), 1, "2026-01-07"),
        RuleVersion(Rule("c", "custom_sql", "s", {"sql_expression": "cast(s as int) > 6"}), 1, "2026-01-03"),
        RuleVersion(Rule("d", "not_null", "nowhere"), 1),
    ]

    def version(k):
        return 1 if k < 3 else None if k < 5 else 2 if k < 8 else 3

    high = {1: 15, 2: 65, 3: 1000}
    want = {k: [("a", version(k), k * 10 <= high[version(k)])] if k < 12 and version(k) else [] for k in range(13)}
    for k in range(12):
        want[k] += [("b", 1, k > 6)] if k >= 6 else []
        want[k] += [("c", 1, k > 6)] if k >= 2 and k != 4 else []
    got = {r.id: [tuple(v) for v in r["_dq_versions"]] for r in annotate_versions(df, history, "day").collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    counts = {(r.rule_id, r.version): (r.total_records, r.passed_count, r.error_message) for r in version_counts(df, history, "day").collect()}
    assert counts["a", 1] == (3, 2, None) and counts["a", 2] == (3, 2, None) and counts["a", 3] == (4, 4, None)
    # a version is in error if it cannot be evaluated on a row of its own time
    assert counts["b", 1] == (6, 5, None) and counts["c", 1] == (0, 0, "cannot be evaluated on 1 rows")
    assert counts["d", 1][:2] == (0, 0) and counts["d", 1][2]
    loaded = versions_from([{"rule_id": "a", "rule_type": "range", "target_column": "n", "params": '{"max": 15}', "version": 1, "valid_from": None, "valid_to": "2026-01-04"}])
    assert loaded[0].rule.params == {"max": 15} and version_counts(df, loaded, "day").first().total_records == 3
    with pytest.raises(RuleError):
        version_counts(df, [RuleVersion(Rule("u", "uniqueness", "id"), 1)], "day")


def test_shuffled_rows_carry_verdicts_and_not_the_columns_of_rules(spark, tmp_path, monkeypatch):
    """Row verdicts go through the shuffles of key rules as bits, and what sets rows aside is known before the first of them."""
    rows = spark.range(3_000).select(
        "id", (F.col("id") % 700).alias("k"), (F.col("id") % 9).alias("m"), (F.col("id") % 50 * 1.5).alias("amount"), F.repeat(F.lit("w"), 300).alias("wide")
    )
    rows.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    rules = [
        Rule("u", "uniqueness", "k", {"columns": ["k", "m"]}, "error", "hard"),
        Rule("a", "range", "amount", {"min": 3}, "error", "hard"),
        Rule("r", "referential_integrity", "k", {"ref_table": "r", "ref_column": "k"}),
        Rule("s", "custom_sql", "amount", {"sql_expression": "amount * 2 > 30"}),
        *[Rule(f"l{i}", "range", "amount", {"max": i}) for i in range(35)],
    ]
    refs = {"r": Reference(spark.range(250).select(F.col("id").alias("k")))}
    verdicts = {how: run_rules(df, rules, Run("q", "d", "2026-01-01 00:00:00"), refs, how) for how in ("row", "sequential")}
    want = {how: sorted(map(str, r.validated.drop("wide").collect())) for how, r in verdicts.items()}
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(keyed, "HOT_ROWS", 5)
    for how in ("row", "sequential"):
        result = run_rules(df, rules, Run("q", "d", "2026-01-01 00:00:00"), refs, how)
        assert sorted(map(str, result.validated.drop("wide").collect())) == want[how]
    v = run_rules(df, rules, Run("q", "d", "2026-01-01 00:00:00"), refs).verdicts
    counted = v.frame.agg(F.count_if(v.clean()), *[F.count_if(v.passed(i)) for i in range(len(rules))])
    plan = counted._jdf.queryExecution().optimizedPlan()
    joins = [n for n in plan.toString().split("\n") if "Join LeftOuter" in n and "from" in n]
    assert len(joins) == 2
    carried = []

    def walk(node):
        if node.nodeName() == "Join" and "__from" in node.toString().split("\n")[0]:
            carried.append({node.children().apply(0).output().apply(i).name() for i in range(node.children().apply(0).output().size())})
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    assert len(carried) == 2 and not any(c & {"amount", "wide"} for c in carried)


def test_keys_are_looked_for_without_the_joins_of_other_rules(spark, monkeypatch):
    """In sequential mode the rows among which a key is counted are joined to nothing that does not hide rows."""
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    from assaylake.plans import verdicts

    seen = []
    monkeypatch.setattr(verdicts, "bad_keys", lambda df, *a: seen.append(df._jdf.queryExecution().analyzed().toString()) or keyed.bad_keys(df, *a))
    rules = [
        Rule("r", "referential_integrity", "k", {"ref_table": "r", "ref_column": "k"}),
        Rule("u", "uniqueness", "k", {}, "error", "hard"),
        Rule("h", "referential_integrity", "k", {"ref_table": "r", "ref_column": "k"}, "error", "hard"),
        Rule("w", "uniqueness", "id"),
    ]
    refs = {"r": Reference(spark.range(250).select(F.col("id").alias("k")))}
    df = spark.range(600).select("id", (F.col("id") % 500).alias("k"))
    log = {r.rule_id: (r.total_records, r.passed_count) for r in run_rules(df, rules, Run("q", "d"), refs, "sequential").log.collect()}
    assert log == {"r": (600, 350), "u": (600, 400), "h": (400, 150), "w": (150, 150)}
    assert "Join" not in seen[0] and seen[1].count("__from") > 0


def test_rows_are_tried_before_they_are_joined(spark, tmp_path, monkeypatch):
    """A run with a rule by a user takes no tally before one is asked for."""
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", -1)
    from assaylake.plans import engine

    taken = []
    monkeypatch.setattr(engine, "tally", lambda v: taken.append(v) or tally(v))
    df = spark.range(100).select("id", (F.col("id") % 30).alias("k"))
    rules = [Rule("u", "uniqueness", "k"), Rule("c", "custom_sql", "id", {"sql_expression": "id > 50"}), Rule("e", "custom_sql", "id", {"sql_expression": "CAST(concat('x', id) AS INT) > 1"})]
    result = run_rules(df, rules, Run("q", "d"))
    assert result.clean.count() == 100 and not taken
    assert {r.rule_id: r.status for r in result.log.collect()} == {"u": "failed", "c": "failed", "e": "error"} and len(taken) == 1
