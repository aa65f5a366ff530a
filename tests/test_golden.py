"""The fixture tables against their known results, in both modes."""

import pytest
from pyspark.sql import functions as F

from assaylake import Run, run_rules
from assaylake.operators import enforce, summary, verdict
from assaylake.plans.compile import compile_rules
from assaylake.plans.metrics import rule_counts
from tests import fixture_data as fx

DATASETS = list(fx.CSVS)


def run(tables, rules, refs, name, mode):
    return run_rules(tables[name], rules[name], Run("run-1", name, fx.AS_OF), refs, mode)


@pytest.mark.parametrize("name", DATASETS)
def test_row_mode(tables, rules, refs, name):
    result = run(tables, rules, refs, name, "row")
    pk = fx.PRIMARY_KEYS[name]
    validated = result.validated.cache()
    rows, n_clean, n_all, passed, _, _ = fx.EXPECTED_DATASETS[name]
    failing = {
        r["rule_id"]: sorted(r["keys"])
        for r in verdict.detail(validated, name, pk, failures_only=True)
        .groupBy("rule_id")
        .agg(F.collect_list("primary_key_value").alias("keys"))
        .collect()
    }
    for rule in rules[name]:
        assert failing.get(rule.rule_id, []) == fx.EXPECTED[rule.rule_id][0], rule.rule_id
    assert enforce.clean(validated).count() == n_clean == result.clean.count()
    assert enforce.quarantine(validated, fx.AS_OF).count() == rows - n_clean == result.quarantine.count()
    assert validated.where("_dq.all_passed").count() == n_all
    got = summary.dataset_summary(result.counts, name, fx.AS_OF).first()
    assert (got.total_records, got.fully_clean_records, got.total_passed) == (rows, n_all, passed)
    assert got.total_evaluations == rows * len(rules[name])


@pytest.mark.parametrize("name", DATASETS)
def test_sequential_mode(tables, rules, refs, name):
    result = run(tables, rules, refs, name, "sequential")
    log = {r.rule_id: (r.total_records, r.failed_count, r.dq_score) for r in result.log.collect()}
    for rule in rules[name]:
        assert log[rule.rule_id] == fx.EXPECTED[rule.rule_id][1], rule.rule_id
    rows, n_clean, _, _, score, entries = fx.EXPECTED_DATASETS[name]
    got = result.score.first()
    assert (got.total_records_in, got.total_records_out) == (rows, n_clean)
    assert got.overall_dq_score == pytest.approx(score, abs=0.005)
    assert got.quarantine_entries == entries == result.entries(fx.PRIMARY_KEYS[name]).count()
    assert got.quarantined_rows == rows - n_clean
    assert result.clean.count() == n_clean


@pytest.mark.parametrize("name", DATASETS)
def test_metrics_without_join_equal_metrics_of_verdicts(tables, rules, refs, name):
    checks = compile_rules(tables[name], rules[name], refs, fx.AS_OF)
    light = sorted(map(tuple, rule_counts(tables[name], checks).collect()))
    full = sorted(map(tuple, run(tables, rules, refs, name, "row").counts.rule_counts().collect()))
    assert light == full


@pytest.mark.parametrize("name", DATASETS)
def test_summaries_equal_those_of_exploded_detail(tables, rules, refs, name):
    result = run(tables, rules, refs, name, "row")
    # The duplicate customer shares its key with another row, so records are counted on a unique key.
    frame = tables[name].withColumn("row_no", F.monotonically_increasing_id())
    unique = run_rules(frame, rules[name], Run("run-1", name, fx.AS_OF), refs)
    detail = verdict.detail(unique.validated, name, "row_no")
    by_dataset, by_rule = summary.summaries_from_detail(detail)
    want = summary.dataset_summary(result.counts, name, fx.AS_OF).first().asDict()
    got = by_dataset.first().asDict()
    assert got == want
    want_rules = sorted(map(tuple, summary.rule_summary(result.counts.rule_counts(), name).collect()))
    assert sorted(map(tuple, by_rule.collect())) == want_rules


def test_flat_detail_equals_struct_detail(tables, rules, refs):
    result = run(tables, rules, refs, "products", "row")
    flat = verdict.annotate(result.verdicts, fx.AS_OF)
    assert "_dq_DQR_000016" in flat.columns and "_dq_row_score" in flat.columns
    a = verdict.detail_flat(flat, list(result.verdicts.rules), "products", "product_id")
    b = verdict.detail(result.validated, "products", "product_id")
    assert a.schema.names == b.schema.names
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_verdict_schema_is_stable(tables, rules, refs):
    from assaylake.schemas import VERDICT

    for some in (rules["customers"], rules["customers"][:1], []):
        frame = run_rules(tables["customers"], some, Run("r", "customers", fx.AS_OF), refs).validated
        assert frame.schema["_dq"].dataType.simpleString() == VERDICT


def test_no_rules(tables, refs):
    result = run_rules(tables["products"], [], Run("r", "products", fx.AS_OF), refs)
    row = result.validated.first()
    assert row["_dq"]["row_score"] == 100.0 and row["_dq"]["all_passed"]
    score = result.score.first()
    assert score.overall_dq_score == 100.0 and score.total_records_out == 15
    assert result.log.count() == 0 and result.entries("product_id").count() == 0


def test_empty_input(tables, rules, refs):
    result = run_rules(tables["customers"].where("false"), rules["customers"], Run("r", "c", fx.AS_OF), refs)
    assert {(r.status, r.dq_score, r.total_records) for r in result.log.collect()} == {("passed", 100.0, 0)}
