"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

With BENCH_CONTROLS=1 the line also holds control runs: the same results the loop-per-rule, window and exploded way.
"""

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.operators import datagen, rulebook, summary, verdict
from assaylake.plans.compile import compile_rules
from assaylake.plans.engine import run_rules
from assaylake.plans.metrics import Run, rule_counts
from assaylake.session import build_session, fresh_path
from assaylake.workload.queries import QUERIES
from assaylake.workload.suites import SUITES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "rule_summary_customer rule_summary_orders rule_summary_lineitem rule_summary_part rule_summary_events "
    "rule_summary_documents uniqueness_lineitem_key ref_integrity_rows_lineitem row_verdicts_customer row_flags_orders "
    "clean_orders quarantine_orders quarantine_entries sequential_log_customer sequential_log_orders "
    "sequential_log_lineitem dataset_scores detail_failures_lineitem rule_contract_audit rule_upsert rule_resolution "
    "rule_coverage customer_360 customer_360_clean sales_by_brand heatmap top_failing_rules feedback_payload "
    "score_trend rule_conflicts profile_orders reconcile_order_lines event_window_metrics stream_window_metrics"
).split()


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def loop_per_rule(df, checks):
    """Two actions per rule, as a rule-at-a-time engine does."""
    for c in checks:
        if c.kind == "row":
            df.count()
            df.where(~c.predicate).count()


def window_uniqueness(df):
    from pyspark.sql.window import Window

    n = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey", "l_linenumber"))
    run(df.withColumn("ok", n == 1))


def controls(spark) -> dict[str, float]:
    out = {}
    path = fresh_path(spark, "bench-transactions")
    datagen.transactions(spark, 1_000_000, 100_000, "2026-04-01").write.parquet(path)
    df = spark.read.parquet(path)
    columns = {
        "transactions": {
            "string": ["transaction_id", "customer_id", "transaction_type", "currency", "merchant", "transaction_date"],
            "numeric": ["amount", "quantity"],
        }
    }
    for n in (5, 50, 150):
        rules = rulebook.to_rules(rulebook.generate_rules(spark, columns, n))
        checks = compile_rules(df, rules)
        out[f"metrics_{n}_rules_one_pass"] = timed(lambda: rule_counts(df, checks).collect())
        if n <= 50:
            out[f"metrics_{n}_rules_loop"] = timed(lambda: loop_per_rule(df, checks))
        result = run_rules(df, rules, Run("bench", "transactions"))
        out[f"validated_{n}_rules"] = timed(lambda: run(result.validated))
        out[f"validated_{n}_rules_failed_only"] = timed(lambda: run(verdict.validated(result.verdicts, results="failed")))
    suite = SUITES["lineitem"]
    d = suite.dataset(spark, SF_DIR)
    unique = [r for r in d.rules if r.rule_type == "uniqueness"]
    out["uniqueness_counts"] = timed(lambda: rule_counts(d.frame, compile_rules(d.frame, unique)).collect())
    out["uniqueness_rows_aggregate"] = timed(lambda: run(run_rules(d.frame, unique, Run("b", "l")).clean))
    out["uniqueness_rows_window"] = timed(lambda: window_uniqueness(d.frame))
    checks = compile_rules(d.frame, d.rules, d.refs, suite.as_of)
    out["summary_one_pass"] = timed(lambda: summary.rule_summary(rule_counts(d.frame, checks), "lineitem").collect())

    def exploded():
        result = run_rules(d.frame, d.rules, Run("b", "lineitem", suite.as_of), d.refs)
        _, by_rule = summary.summaries_from_detail(verdict.detail(result.validated, "lineitem", "l_orderkey"))
        by_rule.collect()

    out["summary_exploded"] = timed(exploded)
    return out


def main() -> None:
    spark = build_session(
        "assaylake-bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["rule_summary_part"](spark, SF_DIR))
    seconds = {name: timed(lambda n=name: run(QUERIES[n](spark, SF_DIR))) for name in HEADLINE}
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_CONTROLS"):
        line["controls"] = controls(spark)
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
