"""The registered queries as plain SQL, for comparison on the same tables.

Verdicts come from the hand-written conditions of the suites; nothing here uses the engine.
"""

from __future__ import annotations

from assaylake.workload import rulebase
from assaylake.workload.queries import LOG_COLUMNS, PROFILED, REPORTED, RUN_ID, SCORE_COLUMNS, SINGLE
from assaylake.workload.suites import SUITES, Suite

ORACLES: dict[str, str] = {}


def rounded(numerator: str, denominator: str, digits: int) -> str:
    """Quotient of integers, rounded half up in integer arithmetic."""
    scale = 10**digits
    top, bottom = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"CAST(({top} * {2 * scale} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {scale}"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"CASE WHEN {whole} = 0 THEN 100.0 ELSE {ratio(part, whole, digits)} END"


def ratio(part: str, whole: str, digits: int) -> str:
    return rounded(f"(({part}) * 100)", f"({whole})", digits)


def cents(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) * 100 AS HUGEINT)"


def mean(column: str, digits: int | None, over: str = "") -> str:
    total, count = f"sum({cents(column)}) {over}", f"count({column}) {over}"
    if digits is None:
        return f"CAST({total} AS DOUBLE) / 100 / {count}"
    return rounded(f"({total})", f"(100 * {count})", digits)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _meta(e: tuple) -> str:
    rid, name, kind, column, _, severity, mode, _ = e
    return (
        f"{_text(rid)} AS rule_id, {_text(name)} AS rule_name, {_text(kind)} AS rule_type, {_text(column)} AS target_column, "
        f"{_text(severity)} AS severity, {_text(mode)} AS enforcement_mode"
    )


def passed_count(s: Suite) -> str:
    return "(" + " + ".join(f"CAST(v{i} AS INTEGER)" for i in range(len(s.able()))) + ")"


def row_score(s: Suite) -> str:
    return ratio(passed_count(s), str(len(s.able())), 2)


def hard_pass(s: Suite) -> str:
    return " AND ".join(f"v{i}" for i, e in enumerate(s.able()) if e[6] == "hard") or "TRUE"


def all_pass(s: Suite) -> str:
    return " AND ".join(f"v{i}" for i in range(len(s.able())))


def failed_rules(s: Suite, sep: str) -> str:
    items = ", ".join(f"CASE WHEN NOT v{i} THEN {_text(e[0])} END" for i, e in enumerate(s.able()))
    return f"concat_ws('{sep}', {items})"


def passed_rules(s: Suite, sep: str) -> str:
    items = ", ".join(f"CASE WHEN v{i} THEN {_text(e[0])} END" for i, e in enumerate(s.able()))
    return f"concat_ws('{sep}', {items})"


def tally_ctes(names: tuple[str, ...]) -> list[str]:
    out = []
    for n in names:
        s = SUITES[n]
        counts = ", ".join(f"count(*) FILTER (WHERE v{i}) AS p{i}" for i in range(len(s.able())))
        out.append(f"v_{n} AS ({s.verdict_sql()})")
        out.append(
            f"a_{n} AS (SELECT count(*) AS n, count(*) FILTER (WHERE {hard_pass(s)}) AS n_clean, "
            f"count(*) FILTER (WHERE {all_pass(s)}) AS n_all, sum({cents(row_score(s))}) AS score, "
            f"{counts} FROM v_{n})"
        )
    return out


def _counts_select(s: Suite, total: str = "n") -> list[str]:
    rows = []
    able = 0
    for e in s.entries:
        if e[7] is None:
            rows.append(
                f"SELECT {_text(s.name)} AS dataset_name, {_meta(e)}, CAST(0 AS BIGINT) AS total_records, "
                f"CAST(0 AS BIGINT) AS passed_count, TRUE AS is_error"
            )
            continue
        rows.append(
            f"SELECT {_text(s.name)} AS dataset_name, {_meta(e)}, CAST(n AS BIGINT) AS total_records, "
            f"CAST(p{able} AS BIGINT) AS passed_count, FALSE AS is_error FROM a_{s.name}"
        )
        able += 1
    return rows


LOG_SELECT = f"""SELECT '{RUN_ID}' AS run_id, dataset_name, rule_id, rule_name, rule_type, target_column, severity, enforcement_mode,
  CASE WHEN is_error THEN 'error' WHEN passed_count < total_records THEN 'failed' ELSE 'passed' END AS status,
  total_records, passed_count, total_records - passed_count AS failed_count,
  CASE WHEN NOT is_error THEN {pct('passed_count', 'total_records')} END AS dq_score FROM counts"""


def log_ctes(names: tuple[str, ...] = REPORTED) -> list[str]:
    rows = [r for n in names for r in _counts_select(SUITES[n])]
    return [*tally_ctes(names), f"counts AS ({' UNION ALL '.join(rows)})", f"log AS ({LOG_SELECT})"]


def by_rule_ctes(names: tuple[str, ...] = REPORTED) -> list[str]:
    return [
        *log_ctes(names),
        f"""by_rule AS (SELECT dataset_name, rule_id, rule_name, rule_type, severity, enforcement_mode AS enforcement, total_records,
  passed_count, total_records - passed_count AS failed_count, {pct('passed_count', 'total_records')} AS pass_rate_pct
  FROM counts WHERE NOT is_error)""",
    ]


def _score_row(s: Suite) -> str:
    k = len(s.able())
    errors = len(s.entries) - k
    total = len(s.entries)
    ps = [f"p{i}" for i in range(k)]
    passed_rules_ = " + ".join(f"CASE WHEN {p} = n THEN 1 ELSE 0 END" for p in ps)
    passed = " + ".join(ps)
    total_cents = " + ".join(cents(f"({pct(p, 'n')})") for p in ps)
    average = rounded(f"({total_cents})", str(100 * k), 2)
    return f"""SELECT {_text(s.name)} AS dataset_name, '{RUN_ID}' AS run_id, {total} AS total_rules, CAST({passed_rules_} AS INTEGER) AS rules_passed,
  CAST({k} - ({passed_rules_}) AS INTEGER) AS rules_failed, {errors} AS rules_errored, {average} AS overall_dq_score,
  CAST(n AS BIGINT) AS total_records_in, CAST(n_clean AS BIGINT) AS total_records_out, CAST(n - n_clean AS BIGINT) AS records_quarantined,
  {pct(f'({passed_rules_})', str(total))} AS rule_pass_ratio, {pct(f'({passed})', f'({k} * n)')} AS pass_rate_pct,
  {rounded('score', '(100 * n)', 2)} AS avg_row_score, CAST(n - n_clean AS BIGINT) AS quarantined_rows,
  CAST({k} * n - ({passed}) AS BIGINT) AS quarantine_entries FROM a_{s.name}"""


def score_ctes(names: tuple[str, ...] = REPORTED, tally: bool = True) -> list[str]:
    rows = " UNION ALL ".join(_score_row(SUITES[n]) for n in names)
    return [*(tally_ctes(names) if tally else []), f"scores AS ({rows})"]


def dataset_ctes(names: tuple[str, ...] = REPORTED, tally: bool = True) -> list[str]:
    rows = []
    for n in names:
        s = SUITES[n]
        k = len(s.able())
        passed = " + ".join(f"p{i}" for i in range(k))
        rows.append(
            f"""SELECT {_text(n)} AS dataset_name, CAST(n * {k} AS BIGINT) AS total_evaluations, CAST({passed} AS BIGINT) AS total_passed,
  CAST(n * {k} - ({passed}) AS BIGINT) AS total_failed, {pct(f'({passed})', f'(n * {k})')} AS pass_rate_pct, CAST(n AS BIGINT) AS total_records,
  CAST(n_all AS BIGINT) AS fully_clean_records, {rounded('score', '(100 * n)', 2)} AS avg_row_score FROM a_{n}"""
        )
    return [*(tally_ctes(names) if tally else []), f"by_dataset AS ({' UNION ALL '.join(rows)})"]


def sql(ctes: list[str], final: str) -> str:
    return f"WITH {', '.join(ctes)} {final}"


# --- single rules -----------------------------------------------------------------------------------------

for _name, (_suite, _rule) in SINGLE.items():
    ORACLES[_name] = sql(log_ctes((_suite,)), f"SELECT {', '.join(LOG_COLUMNS)} FROM log WHERE rule_id = '{_rule}'")

_ORDERS = SUITES["orders"].source_sql()
ORACLES["uniqueness_null_ignored"] = (
    f"SELECT o_orderkey, o_orderpriority IS NULL OR count(*) OVER (PARTITION BY o_custkey, o_orderpriority) = 1 AS is_unique FROM ({_ORDERS})"
)
ORACLES["uniqueness_null_equal"] = (
    f"SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) = 1 AS is_unique FROM ({_ORDERS})"
)
ORACLES["uniqueness_within_status"] = (
    "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus, o_custkey) = 1 AS is_unique FROM orders"
)
ORACLES["ref_integrity_rows_lineitem"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AS order_settled,
       l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40) AS small_part FROM lineitem"""
ORACLES["allowed_values_long_list"] = f"""
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_partkey % 3 = 0 AND l_partkey < 60000) AS p FROM lineitem)
SELECT 'DQR-310001' AS rule_id, 'allowed_values' AS rule_type, 'failed' AS status, CAST(n AS BIGINT) AS total_records,
       CAST(p AS BIGINT) AS passed_count, CAST(n - p AS BIGINT) AS failed_count, {pct('p', 'n')} AS dq_score FROM c"""
_s = SUITES["orders"]
ORACLES["expectation_counts"] = sql(
    log_ctes(("orders",)),
    "SELECT rule_id || '__' || rule_name AS expectation, passed_count AS passed_records, failed_count AS failed_records "
    "FROM log WHERE rule_type NOT IN ('uniqueness', 'referential_integrity')",
)

# --- summaries, verdicts, splits --------------------------------------------------------------------------

for _n in SUITES:
    ORACLES[f"rule_summary_{_n}"] = sql(by_rule_ctes((_n,)), "SELECT * FROM by_rule")
ORACLES["dataset_summary"] = sql(dataset_ctes(tuple(SUITES)), "SELECT * FROM by_dataset")

_c = SUITES["customer"]
_k = len(_c.able())
ORACLES["row_verdicts_customer"] = f"""
SELECT c_custkey, {passed_rules(_c, ',')} AS passed_rules, {failed_rules(_c, ',')} AS failed_rules, {passed_count(_c)} AS passed_count,
       {_k} - {passed_count(_c)} AS failed_count, {_k} AS total_rules, {row_score(_c)} AS row_score, {all_pass(_c)} AS all_passed
FROM ({_c.verdict_sql()})"""
_flags = ", ".join(f"v{i} AS _dq_{e[0].replace('-', '_')}" for i, e in enumerate(_s.able()))
ORACLES["row_flags_orders"] = f"""
SELECT o_orderkey, {_flags}, {len(_s.able())} - {passed_count(_s)} AS _dq_failed_count, {row_score(_s)} AS _dq_row_score
FROM ({_s.verdict_sql()})"""

_bucket = """CASE WHEN s >= 100 THEN '1 - Perfect (100%)' WHEN s >= 80 THEN '2 - Good (80-99%)' WHEN s >= 60 THEN '3 - Fair (60-79%)'
 WHEN s >= 40 THEN '4 - Poor (40-59%)' ELSE '5 - Critical (< 40%)' END"""
_row_scores = " UNION ALL ".join(
    f"SELECT {_text(n)} AS dataset, {row_score(SUITES[n])} AS s FROM ({SUITES[n].verdict_sql()})" for n in REPORTED
)
ORACLES["row_score_distribution"] = (
    f"SELECT {_bucket} AS score_bucket, dataset, count(*) AS row_count FROM ({_row_scores}) GROUP BY ALL"
)
ORACLES["row_score_stats"] = f"""
SELECT dataset, {mean('s', 2)} AS avg_score, min(s) AS min_score, max(s) AS max_score,
       count(*) AS total_rows FROM ({_row_scores}) GROUP BY dataset"""
_cols = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORACLES["clean_orders"] = f"SELECT {_cols} FROM ({_s.verdict_sql()}) WHERE {hard_pass(_s)}"
ORACLES["quarantine_orders"] = f"""
SELECT o_orderkey, o_custkey, o_totalprice, {failed_rules(_s, ', ')} AS _quarantine_reason FROM ({_s.verdict_sql()}) WHERE NOT ({hard_pass(_s)})"""
_e = SUITES["events"]
_soft = " OR ".join(f"NOT v{i}" for i, e in enumerate(_e.able()) if e[6] == "soft")
ORACLES["soft_flag_events"] = f"SELECT event_id, {_soft} AS dq_flag FROM ({_e.verdict_sql()})"
ORACLES["clean_vs_quarantine"] = sql(
    score_ctes(),
    f"""SELECT dataset_name AS dataset, total_records_out AS clean_rows, quarantined_rows AS quarantine_rows, total_records_in AS total_rows,
 avg_row_score AS avg_dq_score, {ratio('total_records_out', 'total_records_in', 2)} AS clean_pct FROM scores""",
)


def _reason(e: tuple) -> str:
    return _text(f"Failed {e[2]} check on column '{e[3]}'")


def _payload(columns: dict[str, str]) -> str:
    items = ", ".join(f"{_text(c)} , {x}" for c, x in columns.items())
    return f"json_object({items})"


_entries = []
for _i, _r in enumerate(_s.able()):
    if _r[0] in ("DQR-200002", "DQR-200005", "DQR-200008"):
        continue
    _entries.append(
        f"""SELECT '{_r[0]}' AS rule_id, '{_r[2]}' AS rule_type, 'orders' AS source_table, CAST(o_orderkey AS VARCHAR) AS record_key,
 '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"' ||
 coalesce(',"o_orderpriority":"' || o_orderpriority || '"', '') || '}}' AS record_payload,
 {_reason(_r)} AS quarantine_reason, '{_r[5]}' AS severity FROM v WHERE NOT v{_i}"""
    )
ORACLES["quarantine_entries"] = f"""
WITH v AS ({_s.verdict_sql()}), e AS ({' UNION ALL '.join(_entries)})
SELECT sha256('{RUN_ID}|orders|' || rule_id || '|' || record_key || '|' || record_payload) AS quarantine_id, * FROM e"""


def sequential_ctes(s: Suite) -> list[str]:
    """Rule by rule: each hard rule leaves its survivors to the next."""
    out = [f"s_{s.name}_0 AS ({s.source_sql()})"]
    for i, e in enumerate(s.able()):
        out.append(f"e_{s.name}_{i} AS (SELECT *, COALESCE(({e[7]}), FALSE) AS ok FROM s_{s.name}_{i})")
        keep = "WHERE ok" if e[6] == "hard" else ""
        out.append(f"s_{s.name}_{i + 1} AS (SELECT * EXCLUDE (ok) FROM e_{s.name}_{i} {keep})")
    return out


def sequential_log(s: Suite) -> str:
    rows, able = [], 0
    for e in s.entries:
        if e[7] is None:
            rows.append(f"SELECT {_text(s.name)} AS dataset_name, {_meta(e)}, CAST(0 AS BIGINT) AS total_records, CAST(0 AS BIGINT) AS passed_count, TRUE AS is_error")
        else:
            rows.append(
                f"SELECT {_text(s.name)} AS dataset_name, {_meta(e)}, count(*) AS total_records, count(*) FILTER (WHERE ok) AS passed_count, "
                f"FALSE AS is_error FROM e_{s.name}_{able}"
            )
            able += 1
    return " UNION ALL ".join(rows)


_seq_entries = " UNION ALL ".join(
    f"SELECT '{e[0]}' AS rule_id, CAST(o_orderkey AS VARCHAR) AS record_key, '{e[5]}' AS severity, {_reason(e)} AS quarantine_reason "
    f"FROM e_orders_{i} WHERE NOT ok"
    for i, e in enumerate(_s.able())
)
ORACLES["quarantine_entries_sequential"] = sql(sequential_ctes(_s), _seq_entries)


def _entry_counts(n: str) -> str:
    s = SUITES[n]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS source_table, '{e[2]}' AS rule_type, '{e[5]}' AS severity, {_reason(e)} AS quarantine_reason FROM v_{n} WHERE NOT v{i}"
        for i, e in enumerate(s.able())
    )


def _verdict_ctes(names: tuple[str, ...]) -> list[str]:
    return [f"v_{n} AS ({SUITES[n].verdict_sql()})" for n in names]


ORACLES["quarantine_volume"] = sql(
    _verdict_ctes(REPORTED),
    f"SELECT source_table, count(*) AS quarantined_count FROM ({' UNION ALL '.join(_entry_counts(n) for n in REPORTED)}) GROUP BY 1",
)
ORACLES["quarantine_breakdown"] = sql(
    _verdict_ctes(REPORTED),
    f"SELECT source_table, rule_type, severity, quarantine_reason, count(*) AS quarantined_count "
    f"FROM ({' UNION ALL '.join(_entry_counts(n) for n in REPORTED)}) GROUP BY ALL",
)
ORACLES["quarantine_by_type"] = sql(
    _verdict_ctes(REPORTED),
    f"SELECT source_table, rule_type, severity, count(*) AS quarantined_count "
    f"FROM ({' UNION ALL '.join(_entry_counts(n) for n in REPORTED)}) GROUP BY ALL",
)
_p = SUITES["part"]
ORACLES["quarantine_listing"] = f"""
SELECT p_partkey, p_name, p_brand, {len(_p.able())} - {passed_count(_p)} AS _dq_failed_count, {row_score(_p)} AS _dq_row_score,
       {failed_rules(_p, ', ')} AS failed_rules, {failed_rules(_p, ', ')} AS _quarantine_reason
FROM ({_p.verdict_sql()}) WHERE NOT ({hard_pass(_p)})"""

for _n in ("customer", "orders", "lineitem", "documents"):
    ORACLES[f"sequential_log_{_n}"] = sql(
        [*sequential_ctes(SUITES[_n]), f"counts AS ({sequential_log(SUITES[_n])})", f"log AS ({LOG_SELECT})"],
        f"SELECT dataset_name, enforcement_mode, {', '.join(LOG_COLUMNS)} FROM log",
    )
ORACLES["dataset_scores"] = sql(score_ctes(), f"SELECT {', '.join(SCORE_COLUMNS)}, avg_row_score FROM scores")


def sequential_scores(names: tuple[str, ...]) -> list[str]:
    ctes, logs, ends = [], [], []
    for n in names:
        s = SUITES[n]
        ctes += sequential_ctes(s)
        logs.append(sequential_log(s))
        ends.append(
            f"SELECT '{n}' AS dataset_name, (SELECT count(*) FROM s_{n}_0) AS total_records_in, (SELECT count(*) FROM s_{n}_{len(s.able())}) AS total_records_out"
        )
    return [
        *ctes,
        f"counts AS ({' UNION ALL '.join(logs)})",
        f"log AS ({LOG_SELECT})",
        f"ends AS ({' UNION ALL '.join(ends)})",
        f"""scores AS (SELECT log.dataset_name, any_value(run_id) AS run_id, CAST(count(*) AS INTEGER) AS total_rules,
 CAST(count(*) FILTER (WHERE status = 'passed') AS INTEGER) AS rules_passed, CAST(count(*) FILTER (WHERE status = 'failed') AS INTEGER) AS rules_failed,
 CAST(count(*) FILTER (WHERE status = 'error') AS INTEGER) AS rules_errored,
 {mean('dq_score', 2)} AS overall_dq_score,
 any_value(total_records_in) AS total_records_in, any_value(total_records_out) AS total_records_out,
 {pct("count(*) FILTER (WHERE status = 'passed')", 'count(*)')} AS rule_pass_ratio,
 {pct('sum(passed_count)', 'sum(total_records)')} AS pass_rate_pct,
 any_value(total_records_in) - any_value(total_records_out) AS quarantined_rows,
 CAST(sum(failed_count) AS BIGINT) AS quarantine_entries
 FROM log JOIN ends USING (dataset_name) GROUP BY log.dataset_name)""",
    ]


_SEQ = sequential_scores(REPORTED)
ORACLES["sequential_scores"] = sql(_SEQ, f"SELECT {', '.join(SCORE_COLUMNS)} FROM scores")
ORACLES["processing_summary"] = sql(
    _SEQ,
    """SELECT dataset_name, run_id, total_records_in AS bronze_count, total_records_out AS silver_count, quarantine_entries AS quarantine_count,
 overall_dq_score AS dq_score, rules_passed, rules_failed FROM scores""",
)
ORACLES["silver_customer"] = sql(
    sequential_scores(("customer",)),
    f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, balance_code, '{RUN_ID}' AS _dq_run_id, "
    f"(SELECT CAST(overall_dq_score AS DOUBLE) FROM scores) AS _dq_score FROM s_customer_{len(_c.able())}",
)


def _detail(n: str) -> str:
    s = SUITES[n]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS dataset_name, {s.key_sql()} AS primary_key_value, '{e[0]}' AS rule_id, '{e[2]}' AS rule_type, "
        f"'{e[3]}' AS target_column, '{e[5]}' AS severity, '{e[6]}' AS enforcement, v{i} AS passed, {row_score(s)} AS row_score, "
        f"{all_pass(s)} AS all_passed FROM v_{n}"
        for i, e in enumerate(s.able())
    )


ORACLES["detail_all"] = sql(_verdict_ctes(REPORTED), " UNION ALL ".join(_detail(n) for n in REPORTED))
ORACLES["detail_failures_lineitem"] = sql(
    _verdict_ctes(("lineitem",)), f"SELECT primary_key_value, rule_id, row_score FROM ({_detail('lineitem')}) WHERE NOT passed"
)
ORACLES["detail_flat_part"] = sql(
    _verdict_ctes(("part",)), f"SELECT primary_key_value, rule_id, passed, row_score FROM ({_detail('part')})"
)
ORACLES["published_orders"] = (
    f"SELECT o_orderkey, CASE WHEN {hard_pass(_s)} THEN 'clean' ELSE 'quarantine' END AS layer FROM ({_s.verdict_sql()})"
)
ORACLES["rerun_log"] = sql(
    log_ctes(("part",)),
    """SELECT r.run_id, count(*) AS rules, count(DISTINCT rule_id) AS ids, CAST(sum(failed_count) AS BIGINT) AS failures
 FROM log, (VALUES ('a'), ('b')) r(run_id) GROUP BY r.run_id""",
)
ORACLES["csv_source_orders"] = sql(
    log_ctes(("orders",)), f"SELECT {', '.join(LOG_COLUMNS)} FROM log WHERE rule_type <> 'referential_integrity'"
)
ORACLES["lineage_orders"] = """
SELECT o_orderkey, 'orders.parquet' AS file_name, 'parquet' AS format, '2001-08-02' AS file_date, 'bronze.orders' AS bronze_table,
       'silver.orders' AS silver_table, 'gold.orders' AS gold_table, TIMESTAMP '2001-08-02 00:00:00' AS processed_at, 'daily' AS pipeline
FROM orders"""

# --- rule tables ------------------------------------------------------------------------------------------

_RAW = f"raw AS ({rulebase.RAW_SQL}), audited AS (SELECT *, {rulebase.ERRORS_SQL} AS reasons FROM raw)"
_VALID = f"{_RAW}, valid AS (SELECT * FROM audited WHERE reasons = '')"
_DAY = "DATE '2000-06-01'"
ORACLES["rule_contract_audit"] = f"WITH {_RAW} SELECT rule_id, rule_type, version, reasons, reasons = '' AS is_valid FROM audited"
ORACLES["rule_normalise"] = f"""WITH {_VALID} SELECT rule_id, rule_name, rule_type, target_column, severity, is_active, version, effective_from,
 effective_to, 'catalogue' AS source_system FROM valid"""
_MERGE = f"t AS ({rulebase.STORED_SQL}), s AS ({rulebase.EXTRACTED_SQL})"
ORACLES["rule_upsert"] = f"""WITH {_MERGE}, m AS (
 SELECT coalesce(t.rule_id, s.rule_id) AS rule_id, coalesce(t.version, s.version) AS version,
  CASE WHEN t.rule_id IS NULL THEN 'inserted' WHEN s.rule_id IS NULL THEN 'kept' WHEN t.severity <> s.severity THEN 'updated' ELSE 'unchanged' END AS action,
  coalesce(s.severity, t.severity) AS severity FROM t FULL JOIN s ON t.rule_id = s.rule_id AND t.version = s.version)
SELECT rule_id, version, severity, CASE WHEN action = 'inserted' THEN DATE '2000-01-01' ELSE DATE '1999-01-01' END AS created_at,
 CASE WHEN action IN ('inserted', 'updated') THEN DATE '2000-01-01' ELSE DATE '1999-01-01' END AS updated_at,
 sha256(rule_id || '|' || severity) AS checksum, action FROM m"""
ORACLES["rule_upsert_by_id"] = f"""WITH {_MERGE}, m AS (
 SELECT coalesce(t.rule_id, s.rule_id) AS rule_id, coalesce(s.version, t.version) AS version,
  CASE WHEN t.rule_id IS NULL THEN 'inserted' WHEN s.rule_id IS NULL THEN 'kept' ELSE 'updated' END AS action,
  coalesce(s.severity, t.severity) AS severity FROM t FULL JOIN s ON t.rule_id = s.rule_id)
SELECT rule_id, version, severity, CASE WHEN action = 'inserted' THEN DATE '2000-01-01' ELSE DATE '1999-01-01' END AS created_at,
 CASE WHEN action IN ('inserted', 'updated') THEN DATE '2000-01-01' ELSE DATE '1999-01-01' END AS updated_at, action FROM m"""
ORACLES["changed_rules"] = f"""WITH {_MERGE} SELECT s.rule_id, s.version, s.severity FROM s
 LEFT JOIN t ON t.rule_id = s.rule_id AND t.severity = s.severity WHERE t.rule_id IS NULL"""
_MAP = f"raw AS ({rulebase.MAPPINGS_SQL}), m AS (SELECT mapping_id, dataset_name, rule_id, coalesce(enforcement_mode, 'soft') AS enforcement_mode, coalesce(priority, 99) AS priority, is_active FROM raw)"
ORACLES["mapping_upsert"] = f"""WITH {_MAP}, t AS (SELECT * FROM m WHERE priority < 3), s AS (SELECT * FROM m WHERE is_active)
SELECT coalesce(t.mapping_id, s.mapping_id) AS mapping_id, coalesce(t.dataset_name, s.dataset_name) AS dataset_name, coalesce(t.rule_id, s.rule_id) AS rule_id,
 coalesce(s.enforcement_mode, 'soft') AS enforcement_mode, coalesce(s.priority, t.priority) AS priority, coalesce(s.is_active, t.is_active) AS is_active,
 CASE WHEN t.mapping_id IS NULL THEN 'inserted' WHEN s.mapping_id IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM t FULL JOIN s ON t.mapping_id = s.mapping_id"""
ORACLES["registry_upsert"] = """
SELECT 'DS-' || s_suppkey AS dataset_id, s_name AS dataset_name, s_acctbal > 0 AS is_active,
 CASE WHEN s_acctbal > 0 THEN DATE '1999-01-01' ELSE DATE '2000-01-01' END AS created_at, DATE '2000-01-01' AS updated_at,
 CASE WHEN s_acctbal > 0 THEN 'updated' ELSE 'inserted' END AS action FROM supplier"""
ORACLES["registry_references_by_dataset"] = """
SELECT 'DS-' || s_suppkey AS dataset_id, s_name AS dataset_name, 'l_partkey_ref' AS ref_name, 'part_bronze' AS ref_table, 'p_partkey' AS ref_column
FROM supplier WHERE s_nationkey % 2 = 0"""
_RESOLVED = """SELECT m.dataset_name, v.rule_id, v.rule_type, v.target_column, v.severity, coalesce(m.enforcement_mode, 'soft') AS enforcement_mode,
 coalesce(m.priority, 999) AS priority FROM valid v JOIN mapped m ON v.rule_id = m.rule_id WHERE v.is_active AND m.is_active"""
ORACLES["rule_resolution"] = f"""WITH {_VALID}, mapped AS ({rulebase.MAPPINGS_SQL}) {_RESOLVED}
 AND v.effective_from <= {_DAY} AND (v.effective_to IS NULL OR v.effective_to >= {_DAY})"""
ORACLES["rule_resolution_no_dates"] = f"WITH {_VALID}, mapped AS ({rulebase.MAPPINGS_SQL}) {_RESOLVED} AND m.dataset_name = 'returns_R'"
ORACLES["effective_rules"] = f"""WITH {_VALID} SELECT rule_id, version, effective_from, effective_to FROM valid
 WHERE effective_from <= {_DAY} AND (effective_to IS NULL OR effective_to >= {_DAY})"""
ORACLES["rule_census"] = f"WITH {_VALID} SELECT rule_type, severity, count(*) AS rule_count FROM valid WHERE is_active GROUP BY ALL"
ORACLES["mapping_census"] = f"WITH {_MAP} SELECT dataset_name, enforcement_mode, count(*) AS mapping_count FROM m WHERE is_active GROUP BY ALL"
ORACLES["rule_coverage"] = f"""WITH {_VALID}, mapped AS ({rulebase.BY_ID_SQL})
SELECT m.dataset_name, count(DISTINCT m.rule_id) AS total_rules,
 count(*) FILTER (WHERE rule_type = 'not_null') AS not_null, count(*) FILTER (WHERE rule_type = 'range') AS range_rules,
 count(*) FILTER (WHERE rule_type = 'regex') AS regex_rules, count(*) FILTER (WHERE rule_type = 'length') AS length_rules,
 count(*) FILTER (WHERE rule_type = 'custom_sql') AS custom_sql, count(*) FILTER (WHERE rule_type = 'allowed_values') AS allowed_vals,
 count(*) FILTER (WHERE rule_type IN ('uniqueness', 'referential_integrity', 'freshness')) AS other
FROM mapped m JOIN valid v ON v.rule_id = m.rule_id WHERE v.is_active GROUP BY m.dataset_name"""
ORACLES["rule_history"] = f"""
WITH v AS (SELECT {rulebase._ID_SQL.format(k='l_partkey')} AS rule_id, CAST(year(l_shipdate) - 1994 AS INTEGER) AS version,
 CAST(min(l_shipdate) AS DATE) AS valid_from FROM lineitem GROUP BY 1, 2),
h AS (SELECT *, lead(valid_from) OVER (PARTITION BY rule_id ORDER BY version) AS valid_to FROM v)
SELECT rule_id, version, valid_from, valid_to, valid_to IS NULL AS is_current FROM h"""
ORACLES["rule_conflicts"] = f"""
WITH r AS ({rulebase.QUANTITY_SQL}), g AS (SELECT l_partkey, count(*) AS rules, max(lo) AS floor, min(hi) AS ceiling FROM r GROUP BY 1)
SELECT 'lineitem' AS dataset_name, 'quantity_of_' || g.l_partkey AS target_column, 'range' AS rule_type, any_value(rules) AS rules,
 any_value(floor) AS floor, any_value(ceiling) AS ceiling, min(rule_id) FILTER (WHERE lo = floor) AS floor_rule,
 min(rule_id) FILTER (WHERE hi = ceiling) AS ceiling_rule
FROM r JOIN g USING (l_partkey) WHERE floor > ceiling GROUP BY g.l_partkey"""
ORACLES["value_conflicts"] = """
WITH v AS (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders),
g AS (SELECT o_custkey, count(DISTINCT o_orderstatus) AS rules FROM v GROUP BY 1),
w AS (SELECT o_custkey, max(n) AS shared_by FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM v GROUP BY 1, 2) GROUP BY 1)
SELECT 'orders' AS dataset_name, 'priority_of_' || o_custkey AS target_column, rules, shared_by FROM g JOIN w USING (o_custkey) WHERE shared_by < rules"""
ORACLES["schema_drift"] = f"WITH {_RAW} SELECT rule_id, 'p_colour' AS target_column FROM raw WHERE severity = 'info'"

# --- business tables --------------------------------------------------------------------------------------


def _metrics(source: str) -> str:
    return f"""SELECT o_custkey, count(*) AS total_transactions, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
 {mean('o_totalprice', 2)} AS avg_transaction_amount,
 max(o_orderdate) AS last_transaction_date, min(o_orderdate) AS first_transaction_date FROM {source} GROUP BY o_custkey"""


_TIER = "CASE WHEN total_transactions >= 5 THEN 'high' WHEN total_transactions >= 2 THEN 'medium' ELSE 'low' END AS engagement_tier"
_VIEW = f"""SELECT c_custkey, c_name, c_mktsegment, total_transactions, total_spend, avg_transaction_amount, last_transaction_date,
 first_transaction_date, {_TIER} FROM customer LEFT JOIN m ON c_custkey = o_custkey"""
ORACLES["customer_360"] = f"WITH m AS ({_metrics('orders')}) {_VIEW}"
ORACLES["customer_360_clean"] = f"""
WITH vo AS ({_s.verdict_sql()}), vc AS ({_c.verdict_sql()}), m AS ({_metrics(f'(SELECT * FROM vo WHERE {hard_pass(_s)})')})
SELECT c_custkey, c_name, c_mktsegment, coalesce(total_transactions, 0) AS total_transactions, coalesce(total_spend, 0.0) AS total_spend,
 coalesce(avg_transaction_amount, 0.0) AS avg_transaction_amount, last_transaction_date, first_transaction_date,
 {_TIER.replace('total_transactions', 'coalesce(total_transactions, 0)')}, {row_score(_c)} AS row_score
FROM (SELECT * FROM vc WHERE {hard_pass(_c)}) LEFT JOIN m ON c_custkey = o_custkey"""
ORACLES["engagement_distribution"] = f"""WITH m AS ({_metrics('orders')}), c AS ({_VIEW})
SELECT engagement_tier, count(*) AS customer_count, {mean('total_spend', 2)} AS avg_spend
FROM c GROUP BY 1"""
ORACLES["part_catalog"] = f"""
SELECT p_partkey, p_name, p_brand, p_type, round(p_retailprice, 2) AS unit_price FROM ({_p.verdict_sql()}) WHERE {hard_pass(_p)}"""
_SALES = f"""SELECT p_brand, count(*) AS total_orders, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
 {mean('l_extendedprice', 2)} AS avg_order_value,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_units_sold FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""
ORACLES["sales_by_brand"] = _SALES
ORACLES["top_brands"] = f"{_SALES} ORDER BY total_revenue DESC, p_brand LIMIT 5"
ORACLES["executive_summary"] = sql(
    score_ctes(),
    """SELECT dataset_name, overall_dq_score, total_rules, rules_passed, rules_failed, rules_errored, total_records_in, total_records_out,
 records_quarantined, run_id FROM scores""",
)

# --- reports ----------------------------------------------------------------------------------------------


def light(x: str, names: tuple[str, str, str]) -> str:
    return f"CASE WHEN {x} >= 95 THEN '{names[0]}' WHEN {x} >= 80 THEN '{names[1]}' ELSE '{names[2]}' END"


ORACLES["overall_score"] = sql(score_ctes(), f"SELECT {mean('overall_dq_score', 1)} AS overall_dq_score FROM scores")
ORACLES["overall_row_score"] = sql(dataset_ctes(), f"SELECT {mean('pass_rate_pct', 1)} AS overall_dq_score FROM by_dataset")
ORACLES["scorecard"] = sql(
    score_ctes(),
    f"""SELECT dataset_name, overall_dq_score, total_rules, rules_passed, rules_failed, rules_errored, total_records_in, total_records_out,
 records_quarantined, {ratio('total_records_out', 'total_records_in', 1)} AS record_pass_rate_pct FROM scores""",
)
ORACLES["pass_rate_by_type"] = sql(
    log_ctes(),
    f"""SELECT rule_type, count(*) AS total_executions, count(*) FILTER (WHERE status = 'passed') AS passed,
 count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'error') AS errored,
 {ratio("count(*) FILTER (WHERE status = 'passed')", 'count(*)', 1)} AS pass_rate_pct,
 {mean('dq_score', 2)} AS avg_dq_score FROM log GROUP BY rule_type""",
)
ORACLES["top_failing_rules"] = sql(
    log_ctes(),
    f"""SELECT rule_id, rule_type, dataset_name, target_column, severity, dq_score, failed_count, total_records,
 {ratio('failed_count', 'total_records', 1)} AS failure_rate_pct FROM log WHERE status = 'failed'
 ORDER BY CAST(failed_count * 100 AS DOUBLE) / total_records DESC, dataset_name, rule_id LIMIT 10""",
)
ORACLES["heatmap"] = sql(
    log_ctes(),
    f"""SELECT dataset_name, rule_type, {mean('dq_score', 1)} AS avg_score,
 {light(mean('dq_score', None), ('GREEN', 'AMBER', 'RED'))} AS health_status FROM log GROUP BY ALL""".replace(
        "GROUP BY ALL", "GROUP BY dataset_name, rule_type"
    ),
)
ORACLES["severity_distribution"] = sql(
    log_ctes(),
    f"""SELECT severity, count(*) AS rule_count, count(*) FILTER (WHERE status = 'passed') AS rules_passed,
 count(*) FILTER (WHERE status = 'failed') AS rules_failed, {mean('dq_score', 2)} AS avg_score,
 CAST(sum(failed_count) AS BIGINT) AS total_failed_records FROM log GROUP BY severity""",
)
ORACLES["rule_detail_report"] = sql(
    log_ctes(),
    f"""SELECT dataset_name, rule_id, rule_type, target_column, severity, enforcement_mode, status, total_records, passed_count, failed_count,
 dq_score, CASE WHEN dq_score IS NOT NULL THEN {light('dq_score', ('HEALTHY', 'WARNING', 'CRITICAL'))} END AS health_status FROM log""",
)
ORACLES["enforcement_effect"] = sql(
    log_ctes(),
    f"""SELECT enforcement_mode, dataset_name, count(*) AS rules_applied, CAST(sum(failed_count) AS BIGINT) AS total_failures_caught,
 {mean('dq_score', 2)} AS avg_dq_score FROM log GROUP BY enforcement_mode, dataset_name""",
)
ORACLES["sla_violations"] = sql(
    log_ctes(),
    """SELECT rule_id, dataset_name, target_column, severity, dq_score, failed_count, total_records,
 CASE WHEN dq_score < 80 AND severity = 'error' THEN 'YES' ELSE 'NO' END AS sla_violation FROM log WHERE status = 'failed'""",
)
ORACLES["execution_listing"] = sql(
    log_ctes(),
    """SELECT rule_id, rule_type, dataset_name, target_column, severity, enforcement_mode, status, total_records, passed_count, failed_count,
 dq_score FROM log""",
)
_BOTH = [*log_ctes(), *score_ctes(tally=False)]
ORACLES["framework_health"] = sql(
    _BOTH,
    f"""SELECT 'Total Datasets Scanned' AS metric, CAST(count(DISTINCT dataset_name) AS VARCHAR) AS value FROM log
 UNION ALL SELECT 'Total Rules Executed', CAST(count(*) AS VARCHAR) FROM log
 UNION ALL SELECT 'Rules Passed', CAST(count(*) FILTER (WHERE status = 'passed') AS VARCHAR) FROM log
 UNION ALL SELECT 'Rules Failed', CAST(count(*) FILTER (WHERE status = 'failed') AS VARCHAR) FROM log
 UNION ALL SELECT 'Total Records Quarantined', CAST(CAST(sum(quarantine_entries) AS BIGINT) AS VARCHAR) FROM scores
 UNION ALL SELECT 'Average DQ Score', CAST({mean('overall_dq_score', 1)} AS VARCHAR) || '%' FROM scores""",
)
_ROWS = [*by_rule_ctes(), *dataset_ctes(tally=False)]
ORACLES["kpi_counters"] = sql(
    _ROWS,
    f"""SELECT 'overall_dq_score' AS metric, {mean('pass_rate_pct', 1)} AS value FROM by_dataset
 UNION ALL SELECT 'total_records', CAST(sum(total_records) AS DOUBLE) FROM by_dataset
 UNION ALL SELECT 'total_rules', CAST(count(DISTINCT rule_id) AS DOUBLE) FROM by_rule
 UNION ALL SELECT 'total_failures', CAST(sum(failed_count) AS DOUBLE) FROM by_rule""",
)
ORACLES["pass_rate_by_dataset"] = sql(
    dataset_ctes(),
    f"""SELECT dataset_name, total_records, fully_clean_records, total_records - fully_clean_records AS impacted_records, pass_rate_pct,
 avg_row_score, total_evaluations, {ratio('fully_clean_records', 'total_records', 1)} AS clean_pct FROM by_dataset""",
)
ORACLES["rule_health"] = sql(
    by_rule_ctes(),
    f"""SELECT rule_id, dataset_name, total_records, passed_count, failed_count, pass_rate_pct,
 {light('pass_rate_pct', ('Healthy', 'Warning', 'Critical'))} AS health_status,
 {light('pass_rate_pct', ('GREEN', 'AMBER', 'RED'))} AS health_colour FROM by_rule""",
)
ORACLES["failures_by_type"] = sql(
    by_rule_ctes(),
    f"""SELECT coalesce(rule_type, 'ALL') AS rule_type, CAST(sum(total_records) AS BIGINT) AS total_evaluations,
 CAST(sum(passed_count) AS BIGINT) AS passed_count, CAST(sum(failed_count) AS BIGINT) AS failed_count,
 {ratio('sum(passed_count)', 'sum(total_records)', 2)} AS pass_rate_pct FROM by_rule GROUP BY ROLLUP (by_rule.rule_type)""",
)
ORACLES["rules_by_severity"] = sql(by_rule_ctes(), "SELECT dataset_name, rule_id, pass_rate_pct, failed_count, severity FROM by_rule")
ORACLES["rule_failure_ranking"] = sql(
    by_rule_ctes(),
    f"""SELECT rule_id, CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(passed_count) AS BIGINT) AS passed,
 CAST(sum(failed_count) AS BIGINT) AS failed, {ratio('sum(passed_count)', 'sum(total_records)', 2)} AS pass_rate FROM by_rule GROUP BY rule_id""",
)


def _worst(s: Suite, columns: str, tail: str = "") -> str:
    k = len(s.able())
    return f"""SELECT {columns}, {k} - {passed_count(s)} AS _dq_failed_count, {passed_count(s)} AS _dq_passed_count, {k} AS _dq_total_rules,
 {row_score(s)} AS _dq_row_score, {failed_rules(s, ', ')} AS failed_rules FROM ({s.verdict_sql()}) WHERE NOT ({all_pass(s)}) {tail}"""


ORACLES["worst_rows"] = _worst(_s, "o_orderkey, o_custkey", "ORDER BY _dq_row_score, o_orderkey, o_custkey LIMIT 50")
ORACLES["failing_rows_part"] = _worst(_p, "p_partkey, p_name")
_FEEDBACK = [
    *_BOTH,
    """payload AS (SELECT rule_id AS asset_id, dataset_name AS dataset, status, dq_score, failed_count, total_records,
 overall_dq_score AS dataset_dq_score, coalesce(severity = 'error' AND dq_score < 80, FALSE) AS sla_violation
 FROM log LEFT JOIN (SELECT dataset_name, overall_dq_score FROM scores) USING (dataset_name))""",
]
ORACLES["feedback_payload"] = sql(_FEEDBACK, "SELECT * FROM payload")
ORACLES["feedback_digest"] = sql(
    _FEEDBACK,
    f"SELECT dataset, count(*) AS updates, {mean('dq_score', 1)} AS avg_dq_score, count(*) FILTER (WHERE sla_violation) AS sla_violations FROM payload GROUP BY dataset",
)

# --- trends and alerts ------------------------------------------------------------------------------------


def _rolling(n: int) -> str:
    over = f"OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)"
    return f"{mean('score', 2, over)} AS score_{n}d"


ORACLES["score_trend"] = f"""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS total, count(*) FILTER (WHERE value BETWEEN 1 AND 100) AS passed FROM events GROUP BY 1, 2),
s AS (SELECT *, {ratio('passed', 'total', 2)} AS score FROM d)
SELECT event_type, day, total, passed, score, {_rolling(7)}, {_rolling(30)} FROM s"""
_DOMAINS = "domains AS (SELECT * FROM (VALUES ('customer', 'sales'), ('orders', 'sales'), ('part', 'supply'), ('events', 'web')) d(dataset_name, domain))"
# One row per domain and day of the score; orders are scored on another day than the rest.
_DAYS = "days AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', DATE '{SUITES[n].as_of[:10]}')" for n in REPORTED) + ") d(dataset_name, day))"
ORACLES["domain_score"] = sql(
    [*score_ctes(), _DOMAINS, _DAYS],
    f"""SELECT domain, count(*) AS datasets, {mean('overall_dq_score', 2)} AS domain_score
 FROM scores JOIN domains USING (dataset_name) JOIN days USING (dataset_name) GROUP BY domain, day""",
)
_RATE = "CAST(quarantined_rows * 100 AS DOUBLE) / total_records_in"
ORACLES["quarantine_rate"] = sql(
    score_ctes(), f"SELECT dataset_name, total_records_in, quarantined_rows, {_RATE} AS quarantine_rate_pct FROM scores"
)
ORACLES["alerts"] = sql(
    _BOTH,
    f"""SELECT dataset_name, 'score' AS alert, CASE WHEN overall_dq_score < 80 THEN 'error' ELSE 'warning' END AS level,
 overall_dq_score AS value, CAST(NULL AS VARCHAR) AS rule_id FROM scores WHERE overall_dq_score < 95
 UNION ALL SELECT dataset_name, 'quarantine_rate', 'warning', {_RATE}, NULL FROM scores WHERE {_RATE} > 10
 UNION ALL SELECT dataset_name, 'rule_error', 'error', NULL, rule_id FROM log WHERE status = 'error'""",
)
ORACLES["circuit_breaker"] = sql(
    score_ctes(),
    f"SELECT dataset_name, {_RATE} AS failure_pct, CAST(25 AS DOUBLE) AS threshold_pct, {_RATE} <= 25 AS publish FROM scores",
)

# --- care of quarantined records --------------------------------------------------------------------------

_RELAXED = {
    "DQR-200001": "TRUE",
    "DQR-200002": "o_totalprice BETWEEN 2000 AND 475000",
    "DQR-200003": "o_orderstatus IN ('F','O')",
    "DQR-200004": "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > -500)",
    "DQR-200005": "o_orderdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 40000 HOUR",
    "DQR-200006": "TRUE",
    "DQR-200007": "coalesce(regexp_matches(o_orderpriority, '^[1-5]-'), FALSE)",
    "DQR-200008": "TRUE",
}
ORACLES["quarantine_reprocess"] = sql(
    _verdict_ctes(("orders",)),
    " UNION ALL ".join(
        f"SELECT '{e[0]}' AS rule_id, CAST(o_orderkey AS VARCHAR) AS record_key, CASE WHEN {_RELAXED[e[0]]} THEN 'reprocessed' ELSE 'open' END AS resolution "
        f"FROM v_orders WHERE NOT v{i}"
        for i, e in enumerate(_s.able())
    ),
)
_l = SUITES["lineitem"]
ORACLES["quarantine_keys_lineitem"] = sql(
    _verdict_ctes(("lineitem",)),
    " UNION ALL ".join(f"SELECT {_l.key_sql()} AS record_key, '{e[0]}' AS rule_id, {_reason(e)} AS quarantine_reason FROM v_lineitem WHERE NOT v{i}" for i, e in enumerate(_l.able())),
)
ORACLES["quarantine_released"] = """
WITH held AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1),
e AS (SELECT * FROM held WHERE o_custkey IN (SELECT o_custkey FROM held WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)),
k AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM (SELECT o_custkey, o_orderpriority FROM e
 UNION ALL SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0) GROUP BY ALL)
SELECT '{"o_orderkey":' || e.o_orderkey || ',"o_custkey":' || e.o_custkey || '}' AS record_key,
 CASE WHEN e.o_orderpriority IS NULL OR n = 1 THEN 'reprocessed' ELSE 'open' END AS resolution
FROM e LEFT JOIN k ON k.o_custkey = e.o_custkey AND k.o_orderpriority IS NOT DISTINCT FROM e.o_orderpriority"""
ORACLES["quarantine_retention"] = sql(
    _verdict_ctes(("orders",)),
    "SELECT rule_id, count(*) AS kept FROM ("
    + " UNION ALL ".join(f"SELECT '{e[0]}' AS rule_id, o_orderdate FROM v_orders WHERE NOT v{i}" for i, e in enumerate(_s.able()))
    + ") WHERE o_orderdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 1095 DAY GROUP BY rule_id",
)
ORACLES["pii_masking"] = sql(
    _verdict_ctes(("customer",)),
    " UNION ALL ".join(
        f"SELECT '{e[0]}' AS rule_id, CAST(c_custkey AS VARCHAR) AS record_key, sha256(c_name) AS c_name, '***' AS c_mktsegment FROM v_customer WHERE NOT v{i}"
        for i, e in enumerate(_c.able())
    ),
)
ORACLES["mask_forms"] = "SELECT s_suppkey, '***@example.com' AS mail, sha256(s_name) AS name FROM supplier"

# --- profiling and reconciliation -------------------------------------------------------------------------


def _profile(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS distinct,
 (SELECT CAST({column} AS VARCHAR) FROM o WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, CAST({column} AS VARCHAR) DESC LIMIT 1) AS top_value,
 (SELECT count(*) FROM o WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC LIMIT 1) AS top_count FROM o"""


ORACLES["profile_orders"] = f"WITH o AS ({_ORDERS}) " + " UNION ALL ".join(_profile(c) for c in PROFILED).replace("AS distinct", 'AS "distinct"')
ORACLES["profile_statistics"] = f"WITH o AS ({_ORDERS}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, CAST((count(*) - count({c})) * 100 AS DOUBLE) / count(*) AS null_pct,
 CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, CAST(min(length(CAST({c} AS VARCHAR))) AS INTEGER) AS min_length,
 CAST(max(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length FROM o"""
    for c in ("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
)
# Every column of orders, and that its approximate figures are within bounds.
ORACLES["profile_approximate"] = f"""WITH o AS ({_ORDERS}) SELECT column_name AS "column", TRUE AS distinct_ok, TRUE AS median_ok
FROM (DESCRIBE SELECT * FROM o)"""
ORACLES["top_values"] = """
WITH c AS (SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2
 UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY 2
 UNION ALL SELECT 'l_quantity', CAST(l_quantity AS VARCHAR), count(*) FROM lineitem GROUP BY 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 5"""
ORACLES["suggested_rules"] = f"""WITH o AS ({_ORDERS}), s AS (SELECT count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi,
 min(length(o_orderpriority)) AS p1, max(length(o_orderpriority)) AS p2, min(length(o_orderstatus)) AS s1, max(length(o_orderstatus)) AS s2 FROM o)
SELECT 'orders' AS dataset_name, 'o_orderkey' AS target_column, 'not_null' AS rule_type, '{{}}' AS params FROM s
 UNION ALL SELECT 'orders', 'o_orderkey', 'uniqueness', '{{"scope":"table"}}' FROM s
 UNION ALL SELECT 'orders', 'o_orderkey', 'range', '{{"min":' || lo || ',"max":' || hi || '}}' FROM s
 UNION ALL SELECT 'orders', 'o_orderstatus', 'not_null', '{{}}' FROM s
 UNION ALL SELECT 'orders', 'o_orderstatus', 'length', '{{"min_length":' || s1 || ',"max_length":' || s2 || '}}' FROM s
 UNION ALL SELECT 'orders', 'o_orderpriority', 'length', '{{"min_length":' || p1 || ',"max_length":' || p2 || '}}' FROM s"""
ORACLES["reconcile_order_lines"] = """
WITH c AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS actual, count(*) AS children FROM lineitem GROUP BY 1),
b AS (SELECT coalesce(o_orderkey, l_orderkey) AS key, CAST(o_totalprice AS DECIMAL(18,4)) AS expected, actual, coalesce(children, 0) AS n,
 coalesce(CAST(o_totalprice AS DECIMAL(18,4)), 0) - coalesce(actual, 0) AS diff FROM orders FULL JOIN c ON o_orderkey = l_orderkey)
SELECT key, CAST(expected AS DOUBLE) AS expected, CAST(actual AS DOUBLE) AS actual, n AS children, CAST(diff AS DOUBLE) AS difference,
 CASE WHEN expected IS NULL THEN 'no_parent' WHEN n = 0 THEN 'no_children' WHEN abs(diff) <= 0.005 THEN 'match' ELSE 'mismatch' END AS status FROM b"""

# --- event time -------------------------------------------------------------------------------------------

_V = {
    "DQR-500001": "event_type IN ('view','click','purchase','signup')",
    "DQR-500002": "value BETWEEN 1 AND 100",
    "DQR-500006": "regexp_matches(props, '\"k\": [1-9][0-9]}')",
}


def _windows(source: str, by: str, rules: dict[str, str], where: str = "") -> str:
    clean = " AND ".join(f"({c})" for c in rules.values())
    lead = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"SELECT window_start, window_end, {lead}count(*) AS total, count(*) FILTER (WHERE {clean}) AS clean, '{rid}' AS rule_id, "
        f"count(*) FILTER (WHERE {cond}) AS passed, CAST(0 AS BIGINT) AS errors "
        f"FROM {source} {where} GROUP BY window_start, window_end{', ' + by if by else ''}"
        for rid, cond in rules.items()
    )


_SIX = """w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS window_start,
 time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') + INTERVAL 6 HOUR AS window_end FROM events)"""
ORACLES["event_window_metrics"] = ORACLES["stream_window_metrics"] = f"WITH {_SIX} {_windows('w', 'event_type', _V)}"
_CLOSED = "WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"
ORACLES["stream_closed_windows"] = f"WITH {_SIX} {_windows('w', 'event_type', _V, _CLOSED)}"
_SLIDING = """WITH d AS (SELECT *, date_trunc('day', ts) AS day FROM events),
w AS (SELECT *, CAST(day AS TIMESTAMP) AS window_start, CAST(day AS TIMESTAMP) + INTERVAL 2 DAY AS window_end FROM d
 UNION ALL SELECT *, CAST(day AS TIMESTAMP) - INTERVAL 1 DAY, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY FROM d)"""
ORACLES["event_sliding_metrics"] = ORACLES["stream_sliding_metrics"] = f"{_SLIDING} {_windows('w', '', _V)}"


def _sessions(source: str) -> str:
    return f"""a AS (SELECT *, ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR AS gap FROM {source}),
b AS (SELECT *, count(*) FILTER (WHERE coalesce(gap, TRUE)) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM a),
s AS (SELECT *, min(ts) OVER (PARTITION BY user_id, session) AS window_start, max(ts) OVER (PARTITION BY user_id, session) + INTERVAL 12 HOUR AS window_end FROM b)"""


ORACLES["event_sessions"] = ORACLES["stream_sessions"] = f"WITH {_sessions('events')} {_windows('s', 'user_id', _V)}"
# Arrival in three parts by event_id % 3; a part's watermark lies an hour behind the latest time of the parts before it.
_PARTS = """m AS (SELECT event_id % 3 AS part, max(ts) AS latest FROM events GROUP BY 1),
e AS (SELECT e.*, (SELECT max(latest) - INTERVAL 1 HOUR FROM m WHERE m.part < e.event_id % 3) AS mark FROM events e)"""
ORACLES["stream_late_rows"] = f"""WITH {_PARTS},
w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS window_start FROM e),
j AS (SELECT *, window_start + INTERVAL 6 HOUR AS window_end, coalesce(window_start + INTERVAL 6 HOUR <= mark, FALSE) AS is_late FROM w)
SELECT window_start, window_end, count(*) FILTER (WHERE NOT is_late) AS total, count(*) FILTER (WHERE is_late) AS late FROM j GROUP BY ALL"""
ORACLES["stream_late_sessions"] = f"""WITH {_PARTS}, t AS (SELECT * FROM e WHERE NOT coalesce(ts + INTERVAL 12 HOUR <= mark, FALSE)),
{_sessions('t')} {_windows('s', 'user_id', _V)}"""
_T = {
    "DQR-510001": "value BETWEEN 1 AND 100",
    "DQR-510002": "event_type <> 'purchase' AND value > 5",
    "DQR-510003": "length(event_type) > 2",
}
_t_clean = " AND ".join(f"({c})" for c in _T.values())
ORACLES["stream_rule_errors"] = f"WITH {_SIX} " + " UNION ALL ".join(
    f"""SELECT window_start, window_end, event_type, count(*) AS total,
 CASE WHEN event_type <> 'purchase' THEN count(*) FILTER (WHERE {_t_clean}) END AS clean, '{rid}' AS rule_id,
 {f"CASE WHEN event_type <> 'purchase' THEN count(*) FILTER (WHERE {c}) END" if rid == "DQR-510002" else f"count(*) FILTER (WHERE {c})"} AS passed,
 CAST({"count(*) FILTER (WHERE event_type = 'purchase')" if rid == "DQR-510002" else "0"} AS BIGINT) AS errors
 FROM w GROUP BY window_start, window_end, event_type"""
    for rid, c in _T.items()
)
_EV = [(i, e) for i, e in enumerate(_e.able()) if e[2] != "uniqueness"]
_ev_fail = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT v{i} THEN '{e[0]}' END" for i, e in _EV) + ")"
_ev_pass = " + ".join(f"CAST(v{i} AS INTEGER)" for i, _ in _EV)
ORACLES["stream_validated_events"] = f"""
SELECT event_id, {_ev_fail} AS failed_rules, {ratio(_ev_pass, str(len(_EV)), 2)} AS row_score FROM ({_e.verdict_sql()})"""
_ev_reason = _ev_fail.replace("concat_ws(','", "concat_ws(', '", 1)
_ev_hard = " AND ".join(f"v{i}" for i, e in _EV if e[6] == "hard") or "TRUE"
ORACLES["stream_quarantine_events"] = f"""
SELECT CASE WHEN {_ev_hard} THEN 'clean' ELSE 'quarantine' END AS sink, event_id, event_type,
 CASE WHEN NOT ({_ev_hard}) THEN {_ev_reason} END AS _quarantine_reason FROM ({_e.verdict_sql()})"""
_part_rules = {e[0]: f"v{i}" for i, e in _EV} | {k: v for k, v in _T.items() if k != "DQR-510002"}
_ev_all = f"(SELECT * FROM ({_e.verdict_sql()}))"
ORACLES["stream_batch_log"] = " UNION ALL ".join(
    f"""SELECT 'stream-' || event_id % 3 AS run_id, '{rid}' AS rule_id, CASE WHEN count(*) FILTER (WHERE {c}) < count(*) THEN 'failed' ELSE 'passed' END AS status,
 count(*) AS total_records, count(*) FILTER (WHERE {c}) AS passed_count, CAST(NULL AS VARCHAR) AS error_message FROM {_ev_all} GROUP BY event_id % 3"""
    for rid, c in _part_rules.items()
) + f""" UNION ALL SELECT 'stream-' || event_id % 3, 'DQR-510002', 'error', CAST(0 AS BIGINT), CAST(0 AS BIGINT),
 'cannot be evaluated on ' || count(*) FILTER (WHERE event_type = 'purchase') || ' rows' FROM events GROUP BY event_id % 3"""
ORACLES["stream_duplicates"] = """
WITH w AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, user_id, event_type FROM events)
SELECT window_start, window_end, user_id, event_type, count(*) AS n FROM w GROUP BY ALL HAVING count(*) > 1"""
ORACLES["stream_first_seen"] = "SELECT DISTINCT user_id, event_type FROM events"


ORACLES["registry_run"] = sql(score_ctes(), f"SELECT {', '.join(SCORE_COLUMNS)}, avg_row_score, TRUE AS timed FROM scores")
_FAILED = " UNION ALL ".join(
    f"SELECT 'DQR-22000{k}' AS rule_id, 'error' AS status, CAST(0 AS BIGINT) AS total_records, CAST(0 AS BIGINT) AS passed_count" for k in range(1, 6)
)
_RAN = " UNION ALL ".join(
    f"""SELECT 'DQR-22000{k}', CASE WHEN count(*) FILTER (WHERE {test}) < count(*) THEN 'failed' ELSE 'passed' END, count(*),
 count(*) FILTER (WHERE {test}) FROM orders"""
    for k, test in ((6, "o_totalprice >= 2000"), (7, "regexp_matches(o_orderpriority, '^[1-5]-')"))
)
ORACLES["error_rules_orders"] = f"{_FAILED} UNION ALL {_RAN}"
ORACLES["sink_modes"] = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'overwritten' WHEN 'O' THEN 'appended' ELSE 'merged' END AS came, count(*) AS n,
 count(*) FILTER (WHERE o_orderstatus = 'P') AS with_status, CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY 1
UNION ALL SELECT 'truncated', 0, NULL, NULL"""
_OF_PART = """SELECT 'DQR-' || lpad(CAST(p_partkey AS VARCHAR), greatest(6, length(CAST(p_partkey AS VARCHAR)))::INT, '0') AS rule_id,
 CASE WHEN p_size > 25 THEN 'error' ELSE 'warning' END AS severity"""
ORACLES["rule_documents"] = f"""
{_OF_PART}, 'json' AS source, CAST(NULL AS VARCHAR) AS params FROM part
UNION ALL {_OF_PART}, 'table', '{{}}' FROM part"""
ORACLES["incremental_lineitem"] = ORACLES["rule_summary_lineitem"]
_VERSIONS = """v(rule_id, version, valid_from, valid_to) AS (VALUES ('DQR-240001', 1, TIMESTAMP '0001-01-01', CAST(NULL AS TIMESTAMP)),
 ('DQR-240001', 2, TIMESTAMP '1996-01-01', TIMESTAMP '1999-07-01'), ('DQR-240001', 3, TIMESTAMP '1999-07-01', NULL),
 ('DQR-240002', 1, TIMESTAMP '1995-01-01', TIMESTAMP '1997-01-01'), ('DQR-240002', 2, TIMESTAMP '1998-01-01', TIMESTAMP '2001-01-01')),
r AS (SELECT DISTINCT rule_id FROM v), o AS (SELECT * FROM orders, r),
j AS (SELECT o.*, v.version, coalesce(CASE o.rule_id || v.version WHEN 'DQR-2400011' THEN o_totalprice >= 1000
 WHEN 'DQR-2400012' THEN o_totalprice BETWEEN 20000 AND 300000 WHEN 'DQR-2400013' THEN o_totalprice <= 400000
 WHEN 'DQR-2400021' THEN o_orderstatus = 'F' ELSE o_orderstatus IN ('F', 'O') END, FALSE) AS passed
 FROM o ASOF JOIN v ON o.rule_id = v.rule_id AND CAST(o.o_orderdate AS TIMESTAMP) >= v.valid_from
 WHERE v.valid_to IS NULL OR CAST(o.o_orderdate AS TIMESTAMP) < v.valid_to)"""
ORACLES["rule_versions_orders"] = f"WITH {_VERSIONS} SELECT o_orderkey, rule_id, version, passed FROM j"
ORACLES["rule_version_counts"] = f"""WITH {_VERSIONS}, c AS (SELECT rule_id, version, count(*) AS n, count(*) FILTER (WHERE passed) AS p FROM j GROUP BY ALL)
SELECT v.rule_id, v.version, coalesce(n, 0) AS total_records, coalesce(p, 0) AS passed_count FROM v LEFT JOIN c ON c.rule_id = v.rule_id AND c.version = v.version"""
_FITS = "o_orderkey % 10 NOT IN (3, 7)"
ORACLES["csv_rescued_orders"] = ORACLES["csv_rescued_stream"] = f"""
SELECT 'bronze' AS went, o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS record, CAST(NULL AS VARCHAR) AS reason FROM orders WHERE {_FITS}
UNION ALL SELECT 'quarantine', NULL, NULL, CASE WHEN o_orderkey % 10 = 3
 THEN o_orderkey || ',' || coalesce(CAST(o_custkey AS VARCHAR), '') || ',' || coalesce(o_orderstatus, '') || ',twelve,' || coalesce(o_orderpriority, '')
 ELSE o_orderkey || ',' || coalesce(CAST(o_custkey AS VARCHAR), '') END,
 CASE WHEN o_orderkey % 10 = 3 THEN 'o_totalprice is not double: twelve' ELSE 'not 5 fields' END FROM orders WHERE NOT ({_FITS})"""
_FOUR = "(SELECT *, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999)"
_SHOWN = {"o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"}
ORACLES["profile_merged"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, {lo} AS min_value, {hi} AS max_value,
 CAST(min(length({t})) AS INTEGER) AS min_length, CAST(max(length({t})) AS INTEGER) AS max_length, TRUE AS distinct_ok, TRUE AS median_ok FROM {_FOUR}"""
    for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority")
    for t in (_SHOWN.get(c, f"CAST({c} AS VARCHAR)"),)
    for lo, hi in ((f"min({t})", f"max({t})") if c in _SHOWN else (f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)"),)
)
ORACLES["frequent_merged"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", value, CAST(sum(n) AS BIGINT) AS at_least, TRUE AS bounds_ok FROM (
 SELECT year, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {_FOUR} WHERE {c} IS NOT NULL GROUP BY ALL) JOIN (
 SELECT year, count(*) AS rows FROM {_FOUR} GROUP BY year) USING (year) WHERE n * 1000 > rows GROUP BY value"""
    for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
)
