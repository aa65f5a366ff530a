"""Rule sources, contract audit, upserts, resolution, registry, sinks, lineage, governance."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from assaylake import Dataset, Rule, Run, process_all, publish, run_registry, run_rules
from assaylake.operators import datagen, enforce, feedback, gold, governance, lineage, profile, reports, rulebook, summary, verdict
from assaylake.plans.registry import PARALLEL_DATASETS
from assaylake.sources import rules as sources
from assaylake.sources import tables as io
from tests import fixture_data as fx


@pytest.fixture(scope="module")
def catalogue(spark, landing):
    raw = sources.read_rules_json(spark, str(landing / "rules.json"))
    mappings = sources.read_mappings_json(spark, str(landing / "mappings.json"))
    return raw, mappings


def test_json_sources_keep_params(catalogue):
    raw, mappings = catalogue
    assert raw.count() == 20 and mappings.count() == 20
    params = {r.rule_id: json.loads(r.params) for r in raw.collect()}
    assert params["DQR-000003"] == {"min": 18, "max": 120}
    assert params["DQR-000004"]["pattern"] == fx.EMAIL


def test_catalogue_rules_resolve_to_the_fixture_rules(spark, catalogue, rules):
    raw, mappings = catalogue
    valid, invalid = rulebook.split_rules(raw)
    assert invalid.count() == 0
    stored = rulebook.normalise_rules(valid, at=fx.AS_OF)
    for name in fx.CSVS:
        resolved = rulebook.resolve_rules(stored, rulebook.normalise_mappings(mappings), f"bronze.{name}", fx.AS_OF)
        assert rulebook.to_rules(resolved) == rules[name]


def test_contract_audit(spark):
    def raw(**kw):
        base = dict(
            rule_id="DQR-000001", rule_name="n", rule_type="not_null", column="c", params="{}", severity="error",
            is_active=True, version=1, effective_from=None, effective_to="", description=None, owner=None,
        )
        return {**base, **kw}

    from assaylake import schemas

    cases = [
        (raw(), []),
        (raw(rule_id="X"), ["bad rule_id"]),
        (raw(rule_id=None), ["missing rule_id"]),
        (raw(rule_type="odd"), ["unknown rule_type"]),
        (raw(severity="fatal", column=""), ["missing column", "unknown severity"]),
        (raw(rule_name="x" * 256), ["rule_name too long"]),
        (raw(version=0), ["bad version"]),
        (raw(effective_from="soon"), ["bad effective_from"]),
        (raw(rule_type="range", params='{"min": 1}'), ["missing params.max"]),
        (raw(rule_type="referential_integrity", params=None), ["missing params.ref_table", "missing params.ref_column"]),
    ]
    names = schemas.RAW_RULE.names
    df = spark.createDataFrame([(i, *[c[n] for n in names]) for i, (c, _) in enumerate(cases)], "i int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_RULE))
    got = {r.i: r.errors for r in rulebook.audit_rules(df).collect()}
    assert got == {i: e for i, (_, e) in enumerate(cases)}


def test_checksum_ignores_key_order(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": 2}'), (1, '{"b": 2, "a": 1}'), (1, '{"b": 3, "a": 1}')], "rule_id int, params string")
    sums = [r[0] for r in df.select(rulebook.rule_checksum(df)).collect()]
    assert sums[0] == sums[1] != sums[2]


def test_upsert_is_idempotent_and_keeps_creation(spark, catalogue):
    raw, _ = catalogue
    first = rulebook.normalise_rules(raw, at="2026-01-01 00:00:00")
    again = rulebook.normalise_rules(raw, at="2026-02-01 00:00:00")
    merged = rulebook.upsert_rules(first, again, "action")
    assert {r.action for r in merged.collect()} == {"unchanged"}
    assert sorted(map(str, merged.drop("action").collect())) == sorted(map(str, first.collect()))
    edited = raw.withColumn("severity", F.when(F.col("rule_id") == "DQR-000003", "info").otherwise(F.col("severity")))
    changed = rulebook.upsert_rules(first, rulebook.normalise_rules(edited, at="2026-02-01 00:00:00"), "action")
    row = changed.where("action = 'updated'").collect()
    assert len(row) == 1 and row[0].severity == "info"
    assert str(row[0].created_at) < str(row[0].updated_at)
    delta = rulebook.changed_rules(first, rulebook.normalise_rules(edited, at="2026-02-01 00:00:00"))
    assert [r.rule_id for r in delta.collect()] == ["DQR-000003"]


def test_effective_dates(spark):
    rows = [("a", "2026-01-01", ""), ("b", "2026-01-01", "2026-03-01"), ("c", "2026-06-01", None), ("d", None, "2026-04-01")]
    df = spark.createDataFrame(rows, "rule_id string, effective_from string, effective_to string")
    assert sorted(r.rule_id for r in rulebook.effective(df, "2026-04-01 10:00:00").collect()) == ["a", "d"]


def test_source_fallback(spark, landing):
    json_path = str(landing / "rules.json")
    assert sources.read_rules(spark, "no_such_table", json_path).count() == 20
    view = rulebook.normalise_rules(sources.read_rules_json(spark, json_path)).where("rule_id < 'DQR-000006'")
    view.createOrReplaceTempView("stored_rules")
    found = sources.read_rules(spark, "stored_rules", json_path)
    assert found.count() == 5 and "column" in found.columns


def test_registry_loop_and_publish(spark, tables, rules, refs, tmp_path):
    datasets = [
        Dataset(f"DS-{i}", n, fx.PRIMARY_KEYS[n], tables[n], tuple(rules[n]), refs) for i, n in enumerate(fx.CSVS)
    ]
    results = process_all(datasets, "run-9", fx.AS_OF)
    assert list(results) == list(fx.CSVS)
    for kind in ("all", "failed"):
        for d in datasets:
            out = publish(results[d.name], d, lambda f, n: io.write_overwrite(f, str(tmp_path / kind / n)), kind)
            rows, clean, _, passed, _, _ = fx.EXPECTED_DATASETS[d.name]
            assert (out["clean"].count(), out["quarantine"].count()) == (clean, rows - clean)
            failures = rows * len(d.rules) - passed
            assert out["detail"].where("NOT passed").count() == failures
            assert out["detail"].count() == (rows * len(d.rules) if kind == "all" else failures)


def test_rerun_replaces_its_own_rows(spark, tables, rules, refs, tmp_path):
    path = str(tmp_path / "log")
    for run_id in ("a", "b", "a"):
        io.write_run(run_rules(tables["products"], rules["products"], Run(run_id, "products", fx.AS_OF), refs).log, path)
    log = spark.read.parquet(path)
    assert {r.run_id: r["count"] for r in log.groupBy("run_id").count().collect()} == {"a": 5, "b": 5}
    ids = log.select("execution_id").distinct().count()
    assert ids == 10
    assert io.without_runs(log, ["a"]).count() == 5


def test_appends_with_other_columns(spark, tmp_path):
    path = str(tmp_path / "merge")
    io.write_append(spark.range(2).withColumn("a", F.lit(1)), path)
    io.append_merging(spark.range(3).withColumn("b", F.lit("x")), path)
    merged = io.read_merging(spark, path)
    assert set(merged.columns) == {"id", "a", "b"} and merged.count() == 5
    assert io.union_merging(spark.range(1).toDF("id"), spark.range(1).withColumn("z", F.lit(1))).columns == ["id", "z"]
    io.truncate(spark, path, "id long")
    assert spark.read.parquet(path).count() == 0


def test_csv_schema(tables):
    assert dict(tables["customers"].dtypes)["created_at"] == "date"
    assert tables["customers"].count() == 16


def test_lineage_layers(spark, tables, rules, refs, tmp_path):
    from assaylake import schemas

    path = str(tmp_path / "products")
    tables["products"].coalesce(1).write.parquet(path)
    bronze = lineage.bronze_stamp(spark.read.parquet(path), "bronze.products", "parquet", "daily", at=fx.AS_OF)
    assert bronze.schema["_lineage"].dataType.simpleString() == schemas.LINEAGE
    result = run_rules(bronze, rules["products"], Run("r", "products", fx.AS_OF), refs)
    silver = lineage.silver_enrich(result.validated, "silver.products", fx.AS_OF)
    catalog = gold.product_catalog(enforce.clean(silver), columns=["product_id"], price="price", gold_table="gold.catalog", processed_at=fx.AS_OF)
    row = catalog.first()["_lineage"]
    assert row.source.file_name.endswith(".parquet") and row.bronze.table == "bronze.products"
    assert row.silver.table == "silver.products" and row.gold.table == "gold.catalog"
    assert catalog.schema["_lineage"].dataType.simpleString() == schemas.LINEAGE
    assert "_lineage" not in lineage.gold_enrich(tables["products"], "x").columns


def test_result_schemas(tables, rules, refs):
    from assaylake import schemas

    result = run_rules(tables["customers"], rules["customers"], Run("r", "customers", fx.AS_OF), refs)
    for frame, schema in (
        (result.log, schemas.EXECUTION_LOG),
        (result.score, schemas.SCORES),
        (result.entries("customer_id"), schemas.QUARANTINE),
    ):
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schema]


def test_quarantine_lifecycle(spark, tables, rules, refs):
    result = run_rules(tables["customers"], rules["customers"], Run("r", "customers", fx.AS_OF), refs)
    entries = result.entries("customer_id")
    assert entries.count() == 16 * 8 - 113
    # With a wider age range two of the three age entries pass; everything else stays open.
    wider = [Rule(r.rule_id, r.rule_type, r.column, {"min": 17, "max": 200} if r.rule_id == "DQR-000003" else r.params, r.severity, r.enforcement) for r in rules["customers"]]
    done = governance.reprocess(entries, tables["customers"].schema, wider, refs, fx.AS_OF)
    assert done.columns == entries.columns
    solved = done.where("resolution_action = 'reprocessed'").collect()
    assert sorted(r.record_key for r in solved) == ["C006", "C009"]
    assert all(r.rule_id == "DQR-000003" for r in solved)
    decisions = entries.select("quarantine_id", F.when(F.col("rule_id") == "DQR-000001", "deleted").otherwise("ignored").alias("action"))
    resolved = governance.resolve_entries(entries, decisions, fx.AS_OF)
    assert [r.rule_id for r in resolved.where("resolved_at IS NOT NULL").collect()] == ["DQR-000001"]
    kept, expired = governance.retain(entries, 90, "2026-07-15 00:00:00")
    assert (kept.count(), expired.count()) == (0, entries.count())


def test_a_duplicate_of_a_clean_row_is_not_released(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, s string")
    rule = Rule("u", "uniqueness", "id", {}, "error", "hard")
    entries = run_rules(df, [rule], Run("r", "d", fx.AS_OF)).entries("s")
    one = entries.where("record_key = 'a'")
    taken, free = (spark.createDataFrame([(k, "z")], "id int, s string") for k in (1, 7))
    open_, solved = (governance.reprocess(one, df.schema, [rule], as_of=fx.AS_OF, clean=c).first().resolution_action for c in (taken, free))
    assert (open_, solved) == (None, "reprocessed")


def test_registry_run_goes_on_after_a_failed_dataset(spark, tables, rules, refs, tmp_path):
    names = list(fx.CSVS)
    datasets = [Dataset(f"DS-{i}", n, fx.PRIMARY_KEYS[n], tables[n], tuple(rules[n]), refs) for i, n in enumerate(names)]
    datasets.insert(1, Dataset("DS-x", "gone", "id", None, (), {}, "table 'gone' cannot be opened"))
    from assaylake import run_registry

    run = run_registry(datasets, "run-3", lambda f, n: io.write_overwrite(f, str(tmp_path / n)), fx.AS_OF)
    assert list(run.results) == names and run.problems == {"gone": "table 'gone' cannot be opened"}
    assert run.log.where("execution_duration_ms IS NULL").count() == 0 and run.scores.count() == 3
    silver = run.results["customers"].silver
    assert silver.select("_dq_score").distinct().collect()[0][0] == run.scores.where("dataset_name = 'customers'").first().overall_dq_score


def test_clean_up_leaves_no_folder(spark):
    import os
    from urllib.parse import urlparse

    from assaylake.session import fresh_path, release, settle

    settle(spark.range(3), "left-over")
    folder = os.path.dirname(urlparse(fresh_path(spark, "x")).path)
    assert os.path.isdir(folder)
    release(spark)
    assert not os.path.isdir(folder)


def test_masked_payload(tables, rules, refs):
    result = run_rules(tables["customers"], rules["customers"], Run("r", "customers", fx.AS_OF), refs)
    masked = result.entries("customer_id", mask={"email": "email", "customer_name": "hash", "phone": "redact"})
    for r in masked.collect():
        payload = json.loads(r.record_payload)
        assert payload.get("email", "***").startswith(("***", "invalid"))
        assert len(payload.get("customer_name", "x" * 64)) == 64
        assert payload.get("phone", "***") == "***"
        assert r.record_key == payload["customer_id"]


def test_conflicts_drift_history(spark):
    rows = [
        ("d", "age", "range", "r1", '{"min": 18, "max": 65}'),
        ("d", "age", "range", "r2", '{"min": 70}'),
        ("d", "age", "range", "r3", '{"max": 90}'),
        ("d", "name", "length", "r4", '{"min_length": 2, "max_length": 9}'),
        ("d", "status", "allowed_values", "r5", '{"values": ["a", "b"]}'),
        ("d", "status", "allowed_values", "r6", '{"values": ["c"]}'),
        ("d", "kind", "allowed_values", "r7", '{"values": ["a", "b"]}'),
        ("d", "kind", "allowed_values", "r8", '{"values": ["b", "c"]}'),
    ]
    df = spark.createDataFrame(rows, "dataset_name string, target_column string, rule_type string, rule_id string, params string")
    (found,) = governance.range_conflicts(df).collect()
    assert (found.target_column, found.floor_rule, found.ceiling_rule, found.floor, found.ceiling) == ("age", "r2", "r1", 70.0, 65.0)
    assert [r.target_column for r in governance.value_conflicts(df).collect()] == ["status"]
    live = governance.schema_columns({"d": spark.createDataFrame([(1, "x", "y")], "age int, name string, kind string")})
    assert {r.rule_id for r in governance.drifted_rules(df, live).collect()} == {"r5", "r6"}
    mappings = spark.createDataFrame([("d", "age", True), ("d", "status", True)], "dataset_name string, column_name string, is_active boolean")
    assert {r.column_name: r.is_active for r in governance.deactivate_drifted(mappings, live).collect()} == {"age": True, "status": False}
    versions = spark.createDataFrame([("r", 1, "2026-01-01"), ("r", 1, "2026-01-01"), ("r", 2, "2026-03-01")], "rule_id string, version int, effective_from string")
    got = [(r.version, r.valid_to, r.is_current) for r in governance.rule_history(versions).orderBy("version").collect()]
    assert got == [(1, "2026-03-01", False), (2, None, True)]


def test_generated_data_do_not_depend_on_partitioning(spark):
    one = datagen.customers(spark, 400, "2026-04-01").coalesce(1).collect()
    many = datagen.customers(spark, 400, "2026-04-01").repartition(7).orderBy("customer_id").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    bad = datagen.customers(spark, 400, "2026-04-01").where("customer_name IS NULL OR email IS NULL OR age = 150 OR email = 'invalid-email-format' OR phone = '12345' OR status = 'deleted' OR country_code = 'ZZ'")
    assert bad.count() == 7 * 20
    assert datagen.products(spark, 100, "2026-04-01").where("sku = 'INVALID_SKU'").count() == 5
    assert datagen.transactions(spark, 100, 10, "2026-04-01").where("amount IS NULL").count() == 5


def test_profile_and_suggestions(spark, tables):
    p = {r.column: r for r in profile.profile(tables["customers"]).collect()}
    assert p["email"].nulls == 1 and p["age"].min_value == "-5" and p["age"].max_value == "150"
    assert p["customer_id"].rows == 16 and p["customer_id"].approx_distinct == 15
    got = {(r.target_column, r.rule_type) for r in profile.suggest_rules(profile.profile(tables["products"]), "products").collect()}
    assert ("product_id", "uniqueness") in got and ("price", "range") in got and ("product_name", "not_null") not in got
    suggested = profile.suggest_rules(profile.profile(tables["products"]), "products").collect()
    mined = [Rule(f"S{i}", r.rule_type, r.target_column, json.loads(r.params)) for i, r in enumerate(suggested)]
    assert {r.status for r in run_rules(tables["products"], mined, Run("r", "p")).log.collect()} == {"passed", "failed"}


def test_feedback_payload(tables, rules, refs):
    result = run_rules(tables["customers"], rules["customers"], Run("r", "customers", fx.AS_OF), refs, "sequential")
    rows = {r.asset_id: r for r in feedback.feedback_payload(result.log, result.score, "r").collect()}
    assert rows["DQR-000003"].sla_violation and not rows["DQR-000005"].sla_violation
    payload = json.loads(rows["DQR-000003"].payload)
    assert payload["Last DQ Score"] == 78.57 and payload["Dataset DQ Score"] == 87.29 and payload["SLA Violation"] is True
    assert feedback.feedback_payload(result.log, result.score, "other").count() == 0
    digest = feedback.feedback_digest(feedback.feedback_payload(result.log, result.score)).first()
    assert (digest.updates, digest.sla_violations) == (8, 1)


def test_reports_on_empty_tables(tables, rules, refs):
    result = run_rules(tables["customers"].where("false"), rules["customers"], Run("r", "c", fx.AS_OF), refs)
    assert reports.scorecard(result.score).first().record_pass_rate_pct is None
    assert reports.top_failing_rules(result.log).count() == 0
    assert enforce.gate(result.score).first().publish


def test_registry_tables_drive_the_run(spark, catalogue, tables, tmp_path):
    raw, mappings = catalogue
    stored = rulebook.normalise_rules(raw, at=fx.AS_OF)
    ids = {n: f"DS-00{i}" for i, n in enumerate(fx.CSVS, 1)}
    refs = {
        "customers": '{"country_code_ref": {"dlt_table": "ref_dim_country", "ref_column": "country_code"}}',
        "transactions": '{"customer_id_ref": {"dlt_table": "customers_bronze", "ref_column": "customer_id"}}',
    }
    rows = [(ids[n], n, f"bronze.{n}", fx.PRIMARY_KEYS[n], refs.get(n), True) for n in fx.CSVS]
    rows.append(("DS-009", "retired", "bronze.retired", "id", None, False))
    registry = spark.createDataFrame(rows, "dataset_id string, dataset_name string, source_table string, primary_key string, ref_tables string, is_active boolean")
    by_id = mappings.select(
        "mapping_id",
        F.element_at(F.create_map(*[F.lit(x) for n in ids for x in (f"bronze.{n}", ids[n])]), F.col("dataset_name")).alias("dataset_id"),
        "column_name", "rule_id", "enforcement_mode", "priority", "is_active",
    )
    shop = {f"bronze.{n}": tables[n] for n in fx.CSVS}
    shop |= {"ref_dim_country": tables["dim_country"], "customers_bronze": tables["customers"]}
    from assaylake import datasets_from_registry, run_registry

    found = datasets_from_registry(registry, by_id, stored, shop.__getitem__, fx.AS_OF)
    assert [d.name for d in found] == list(fx.CSVS)
    run = run_registry(found, "run-7", lambda f, n: io.write_overwrite(f, str(tmp_path / n)), fx.AS_OF, results="failed", threshold_pct=32.0)
    # customers loses 5 of 16 rows, the others 5 of 15: only customers stays under the threshold.
    assert list(run.tables) == ["customers"]
    assert run.tables["customers"]["clean"].count() == 11
    scores = {r.dataset_name: r for r in run.scores.collect()}
    for name, (n, clean, full, passed, _, _) in fx.EXPECTED_DATASETS.items():
        assert (scores[name].total_records_in, scores[name].total_records_out, scores[name].rules_errored) == (n, clean, 0)
        assert scores[name].quarantine_entries == n * len([r for r in fx.RULES if r[2] == name]) - passed
    # Without its reference a rule becomes an error row and the others still run.
    del shop["ref_dim_country"]
    again = datasets_from_registry(registry.where("dataset_name = 'customers'"), by_id, stored, shop.__getitem__, fx.AS_OF)
    log = {r.rule_id: r.status for r in run_rules(again[0].frame, again[0].rules, Run("x", "customers", fx.AS_OF), again[0].refs).log.collect()}
    assert log["DQR-000008"] == "error" and len(log) == 8


def test_a_registry_run_reads_each_dataset_once(spark, tmp_path):
    """Every row of the source passes one task: a rule by a user counts the rows it is asked about."""
    path = str(tmp_path / "rows")
    spark.range(1000).select("id", (F.col("id") % 900).alias("k"), F.col("id").cast("string").alias("s")).repartition(4).write.parquet(path)
    opened = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            opened.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(path)
    df = source.mapInArrow(count, source.schema)
    rules = (
        Rule("not", "not_null", "s"),
        Rule("sql", "custom_sql", "s", {"sql_expression": "cast(s as int) < 900"}, enforcement="hard"),
        Rule("range", "range", "id", {"max": 899}),
    )
    dataset = Dataset("D", "d", "id", df, rules, {})
    run = run_registry([dataset], "run-1", lambda f, n: io.write_overwrite(f, str(tmp_path / n)), fx.AS_OF, results="failed")
    assert opened.value == 1000
    score = run.scores.first()
    assert (score.total_records_in, score.total_records_out, score.rules_failed) == (1000, 900, 2)
    assert {r.rule_id: r.passed_count for r in run.log.collect()} == {"not": 1000, "sql": 900, "range": 900}
    assert run.tables["d"]["clean"].count() == 900 and run.log.where("execution_duration_ms IS NULL").count() == 0
    assert opened.value == 1000
    # the gate: rows are kept aside until it is known whether they may be published
    opened.value = 0
    for threshold, tables in ((5.0, {}), (50.0, {"d"})):
        gated = run_registry([dataset], "run-2", lambda f, n: io.write_overwrite(f, str(tmp_path / f"gated-{n}")), fx.AS_OF, threshold_pct=threshold)
        assert set(gated.tables) == set(tables)
    assert opened.value == 2000
    # a key rule counts its keys beside; only a rule that turns out not to be evaluable costs a second pass
    opened.value = 0
    keyed = replace(dataset, rules=(*rules, Rule("u", "uniqueness", "k")))
    run = run_registry([keyed], "run-3", lambda f, n: io.write_overwrite(f, str(tmp_path / f"keyed-{n}")), fx.AS_OF)
    assert opened.value == 2000 and {r.rule_id: r.passed_count for r in run.log.collect()}["u"] == 800
    opened.value = 0
    failing = replace(dataset, rules=(*rules, Rule("bad", "custom_sql", "k", {"sql_expression": "1 / (k - 7) < 2"})))
    run = run_registry([failing], "run-4", lambda f, n: io.write_overwrite(f, str(tmp_path / f"failing-{n}")), fx.AS_OF)
    assert opened.value == 2000
    log = {r.rule_id: (r.status, r.error_message) for r in run.log.collect()}
    assert log["bad"] == ("error", "cannot be evaluated on 2 rows") and log["sql"][0] == "failed"
    assert run.tables["d"]["validated"].first()["_dq"]["total_rules"] == 3


def test_a_registry_run_takes_datasets_as_it_goes(spark, tmp_path):
    """The next dataset is asked for when a place is free, not before."""
    asked, finished = [], []
    frame = spark.range(5)

    def datasets():
        for k in range(7):
            asked.append(k - len(finished))
            yield Dataset(str(k), f"d{k}", "id", None if k == 3 else frame, (Rule("a", "range", "id", {"max": 2}),), {}, "no table")

    def write(df, name):
        out = io.write_overwrite(df, str(tmp_path / name))
        finished.append(name)
        return out

    run = run_registry(datasets(), "r", write)
    assert set(run.results) == {"d0", "d1", "d2", "d4", "d5", "d6"} and run.problems == {"d3": "no table"}
    assert max(asked) <= PARALLEL_DATASETS + 1 and run.scores.count() == 6


def test_record_keys_of_several_columns(spark):
    """The key goes through detail, quarantine log, reprocessing and resolution; NULLs stay in it."""
    df = spark.createDataFrame([(1, "a", 5), (1, None, 50), (2, "b", 500)], "x int, y string, n int")
    rule = Rule("low", "range", "n", {"max": 9}, enforcement="hard")
    result = run_rules(df, [rule], Run("r", "d", fx.AS_OF))
    keys = ['{"x":1,"y":null}', '{"x":2,"y":"b"}']
    entries = result.entries(("x", "y"))
    assert sorted(r.record_key for r in entries.collect()) == keys
    held = verdict.detail(result.validated, "d", ("x", "y"), failures_only=True)
    assert sorted(r.primary_key_value for r in held.collect()) == keys
    flat = verdict.detail_flat(verdict.annotate(result.verdicts), [rule], "d", ("x", "y"))
    assert sorted(r.primary_key_value for r in flat.where("NOT passed").collect()) == keys
    done = governance.reprocess(entries, df.schema, [replace(rule, params={"max": 99})])
    assert {r.record_key: r.resolution_action for r in done.collect()} == {keys[0]: "reprocessed", keys[1]: None}
    decisions = entries.select("quarantine_id", F.when(F.col("record_key") == keys[1], "deleted").otherwise("unknown").alias("action"))
    assert {r.record_key: r.resolution_action for r in governance.resolve_entries(entries, decisions).collect()} == {keys[0]: None, keys[1]: "deleted"}
    by_dataset, _ = summary.summaries_from_detail(verdict.detail(result.validated, "d", ("x", "y")))
    assert by_dataset.first().total_records == 3


def test_registries_name_keys_of_several_columns(spark):
    registry = spark.createDataFrame(
        [("D1", "one", "t", "id", None, True), ("D2", "two", "t", " a, b ", None, True)],
        "dataset_id string, dataset_name string, source_table string, primary_key string, ref_tables string, is_active boolean",
    )
    from assaylake import datasets_from_registry
    from assaylake.schemas import MAPPINGS_BY_ID, RULES

    none, rules = (spark.createDataFrame([], schema) for schema in (MAPPINGS_BY_ID, RULES))
    found = datasets_from_registry(registry, none, rules, lambda name: spark.range(1), fx.AS_OF, check_dates=False)
    assert [d.primary_key for d in found] == ["id", ("a", "b")]


def test_broken_records_are_kept_apart(spark, tmp_path):
    from pyspark.sql import types as T

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('id,day,name\n1,2026-01-01,"a, b"\n2,yesterday,c\nx,2026-01-01,\n3\n4,2026-01-02,d,extra\n5,,\n')
    (folder / "b.csv").write_text("id,day,name\n6,2026-01-03,e\nseven,tomorrow,f\n")
    schema = T.StructType().add("id", T.IntegerType()).add("day", T.DateType()).add("name", T.StringType())
    landed = io.land(spark, str(folder), schema, str(tmp_path / "landed"))
    good = sorted((r.id, str(r.day), r.name) for r in io.fitting(landed).collect())
    assert good == [(1, "2026-01-01", "a, b"), (5, "None", None), (6, "2026-01-03", "e")] and io.fitting(landed).schema == schema
    bad = {r.record: (r.source_file.rsplit("/", 1)[1], r.reason) for r in io.rescued(landed).collect()}
    assert bad == {
        "2,yesterday,c": ("a.csv", "day is not date: yesterday"),
        "x,2026-01-01,": ("a.csv", "id is not int: x"),
        "3": ("a.csv", "not 3 fields"),
        "4,2026-01-02,d,extra": ("a.csv", "not 3 fields"),
        "seven,tomorrow,f": ("b.csv", "id is not int: seven; day is not date: tomorrow"),
    }
