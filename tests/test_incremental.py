"""Validation by batches against validation of the whole table."""

from pyspark.sql import functions as F

from assaylake import Reference, Rule, compile_rules
from assaylake.plans import incremental
from assaylake.plans.incremental import add_batch, counts_so_far, refresh_reference
from assaylake.plans.metrics import rule_counts

RULES = [
    Rule("low", "range", "n", {"max": 60}, enforcement="hard"),
    Rule("text", "custom_sql", "s", {"sql_expression": "cast(s as int) % 7 > 0"}),
    Rule("key", "uniqueness", "k"),
    Rule("pair", "uniqueness", "k", {"columns": ["k", "s"], "nulls": "equal"}),
    Rule("ref", "referential_integrity", "k", {"ref_table": "r", "ref_column": "v"}),
    Rule("gone", "not_null", "nowhere"),
]


def table(spark):
    k = F.when(F.col("id") % 10 < 4, 7).when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919) % 400)
    return spark.range(1200).select("id", k.cast("int").alias("k"), (F.col("id") % 100).alias("n"), (F.col("id") % 50).cast("string").alias("s"))


def refs_of(spark, n):
    return {"r": Reference(spark.range(n).select(F.col("id").cast("int").alias("v")))}


def plain(counts):
    return sorted((r.position, r.rule_id, r.total_records, r.passed_count, r.error_message is None) for r in counts.collect())


def batches(spark, df, path):
    """Three batches that share keys, whose rows are counted when they are read."""
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    for k in range(3):
        df.where(F.col("id") % 3 == k).write.parquet(f"{path}/{k}")
        source = spark.read.parquet(f"{path}/{k}")
        yield source.mapInArrow(count, source.schema), seen


def test_batches_add_up_without_old_rows(spark, tmp_path):
    df, refs, state = table(spark), refs_of(spark, 300), str(tmp_path / "state")
    done = None
    keys = 1 + len([r for r in RULES if r.rule_type in ("uniqueness", "referential_integrity")])
    for k, (batch, seen) in enumerate(batches(spark, df, str(tmp_path / "in"))):
        before = seen.value
        add_batch(batch, RULES, state, k, refs)
        # the row rules read the batch once, each key rule its keys; nothing that came before is read
        assert seen.value - before <= keys * 400
        part = df.where(F.col("id") % 3 == k)
        done = part if done is None else done.unionByName(part)
        assert plain(counts_so_far(spark, RULES, state)) == plain(rule_counts(done, compile_rules(done, RULES, refs)))
    # as it was after the second batch
    two = df.where("id % 3 < 2")
    assert plain(counts_so_far(spark, RULES, state, upto=1)) == plain(rule_counts(two, compile_rules(two, RULES, refs)))


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 8)
    df, refs, state = table(spark), refs_of(spark, 300), str(tmp_path / "state")
    parts = [df.where(F.col("id") % 3 == k) for k in range(3)]
    for k in (0, 1, 1, 2, 2):
        add_batch(parts[k].where("id < 100") if k == 1 else parts[k], RULES, state, k, refs)
    whole = parts[0].unionByName(parts[1].where("id < 100")).unionByName(parts[2])
    assert plain(counts_so_far(spark, RULES, state)) == plain(rule_counts(whole, compile_rules(whole, RULES, refs)))


def test_small_batches_touch_few_buckets(spark, tmp_path):
    state = str(tmp_path / "state")
    rule = RULES[2]
    add_batch(table(spark), [rule], state, 0)
    add_batch(table(spark).where("id = 13"), [rule], state, 1)
    folder = incremental._folder(state, rule)
    buckets = lambda k: spark.read.parquet(f"{folder}/merged/batch={k}").select("bucket").distinct().count()
    assert buckets(0) == incremental.BUCKETS and buckets(1) == 1


def test_changed_rules_and_references(spark, tmp_path):
    df, state = table(spark), str(tmp_path / "state")
    parts = [df.where("id < 600"), df.where("id >= 600")]
    add_batch(parts[0], RULES, state, 0, refs_of(spark, 300))
    changed = [Rule("low", "range", "n", {"max": 10}), *RULES[1:]]
    add_batch(parts[1], changed, state, 1, refs_of(spark, 300))
    got = {r.rule_id: (r.total_records, r.passed_count) for r in counts_so_far(spark, changed, state).collect()}
    assert got["low"] == (600, parts[1].where("n <= 10").count()) and got["key"][0] == 1200
    # the reference loses keys: all that came before is judged again, by keys
    smaller = refs_of(spark, 20)
    refresh_reference(df, RULES[4], state, 1, smaller)
    want = rule_counts(df, compile_rules(df, RULES[4:5], smaller)).first()
    got = {r.rule_id: (r.total_records, r.passed_count) for r in counts_so_far(spark, changed, state).collect()}
    assert got["ref"] == (want.total_records, want.passed_count)
    add_batch(df.where("id < 5"), changed, state, 2, smaller)
    both = df.unionByName(df.where("id < 5"))
    want = rule_counts(both, compile_rules(both, RULES[4:5], smaller)).first()
    got = {r.rule_id: (r.total_records, r.passed_count) for r in counts_so_far(spark, changed, state).collect()}
    assert got["ref"] == (want.total_records, want.passed_count)


def test_empty_batches_and_no_state(spark, tmp_path):
    df, state = table(spark), str(tmp_path / "state")
    refs = refs_of(spark, 300)
    assert all(r.total_records == 0 and r.error_message is None for r in counts_so_far(spark, RULES, state).collect())
    add_batch(df.where("false"), RULES, state, 0, refs)
    add_batch(df.where("id < 300"), RULES, state, 1, refs)
    some = df.where("id < 300")
    assert plain(counts_so_far(spark, RULES, state)) == plain(rule_counts(some, compile_rules(some, RULES, refs)))


def test_an_error_of_one_batch_is_an_error_of_all(spark, tmp_path):
    state = str(tmp_path / "state")
    rule = [RULES[1]]
    add_batch(spark.createDataFrame([(1, "5")], "n int, s string"), rule, state, 0)
    add_batch(spark.createDataFrame([(1, "x"), (2, "5")], "n int, s string"), rule, state, 1)
    add_batch(spark.createDataFrame([(1, "8")], "n int, s string"), rule, state, 2)
    row = counts_so_far(spark, rule, state).first()
    assert (row.total_records, row.passed_count, row.error_message) == (0, 0, "cannot be evaluated on 1 rows")
