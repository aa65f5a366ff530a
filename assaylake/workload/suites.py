"""Rule suites over the benchmark tables.

Each suite has a dataset view, its rules in priority order, and for each rule the same condition in SQL, written
by hand, against which the engine is compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.model import Reference, Rule
from assaylake.plans.engine import Dataset

AS_OF = {"orders": "2001-08-02 00:00:00", "lineitem": "2001-08-02 00:00:00", "events": "2024-01-31 00:00:00"}
DEFAULT_AS_OF = "2024-01-31 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Suite:
    name: str
    primary_key: str | tuple[str, ...]
    # Columns the view adds or replaces: name -> (Spark SQL expression, same in DuckDB).
    view: dict[str, tuple[str, str]]
    # (rule id, name, type, column, params, severity, mode, SQL condition)
    entries: tuple[tuple, ...]
    # reference name -> (table, Spark filter); the SQL conditions spell the references out.
    refs: dict[str, tuple[str, str]]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = load(spark, sf_dir, self.name)
        return df.withColumns({n: F.expr(e) for n, (e, _) in self.view.items()}) if self.view else df

    def rules(self) -> tuple[Rule, ...]:
        return tuple(
            Rule(rid, kind, column, params, severity, mode, name, i)
            for i, (rid, name, kind, column, params, severity, mode, _) in enumerate(self.entries, 1)
        )

    def dataset(self, spark: SparkSession, sf_dir: str) -> Dataset:
        refs = {n: Reference(load(spark, sf_dir, t).where(cond)) for n, (t, cond) in self.refs.items()}
        return Dataset(f"DS-{self.name}", self.name, self.primary_key, self.frame(spark, sf_dir), self.rules(), refs)

    @property
    def as_of(self) -> str:
        return AS_OF.get(self.name, DEFAULT_AS_OF)

    # --- the SQL side -------------------------------------------------------------------------------------

    def source_sql(self) -> str:
        if not self.view:
            return f"SELECT * FROM {self.name}"
        replaced = [n for n in self.view if n not in NEW_COLUMNS]
        items = ", ".join(f"{e} AS {n}" for n, (_, e) in self.view.items())
        star = f"* EXCLUDE ({', '.join(replaced)})" if replaced else "*"
        return f"SELECT {star}, {items} FROM {self.name}"

    def key_sql(self) -> str:
        """The record key as text; all keys of several columns are numbers that are never NULL."""
        if isinstance(self.primary_key, str):
            return f"CAST({self.primary_key} AS VARCHAR)"
        return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {k}" for k in self.primary_key) + " || '}'"

    def able(self) -> list[tuple]:
        return [e for e in self.entries if e[7] is not None]

    def verdict_sql(self) -> str:
        """The view with one boolean ``v<i>`` per rule that can run."""
        flags = ", ".join(f"COALESCE(({e[7]}), FALSE) AS v{i}" for i, e in enumerate(self.able()))
        return f"SELECT *, {flags} FROM ({self.source_sql()}) src"


NEW_COLUMNS = {"balance_code"}

CUSTOMER = Suite(
    "customer",
    "c_custkey",
    {"balance_code": ("CAST(floor(c_acctbal / 2) AS BIGINT)", "CAST(floor(c_acctbal / 2) AS BIGINT)")},
    (
        ("DQR-100001", "Balance range", "range", "c_acctbal", {"min": -500, "max": 9500}, "error", "hard",
         "c_acctbal >= -500 AND c_acctbal <= 9500"),
        ("DQR-100002", "Known segment", "allowed_values", "c_mktsegment",
         {"values": ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]}, "warning", "soft",
         "c_mktsegment IN ('BUILDING','AUTOMOBILE','MACHINERY','HOUSEHOLD')"),
        ("DQR-100003", "Name pattern", "regex", "c_name", {"pattern": r"^Customer#\d{8}[0-8]$"}, "warning", "soft",
         r"regexp_matches(c_name, '^Customer#\d{8}[0-8]$')"),
        ("DQR-100004", "Unique balance", "uniqueness", "balance_code", {"scope": "table"}, "error", "hard",
         "count(*) OVER (PARTITION BY balance_code) = 1"),
        ("DQR-100005", "Known nation", "referential_integrity", "c_nationkey",
         {"ref_table": "nation", "ref_column": "n_nationkey"}, "warning", "soft",
         "c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)"),
        ("DQR-100006", "Name length", "length", "c_name", {"min_length": 18, "max_length": 18}, "info", "hard",
         "length(c_name) BETWEEN 18 AND 18"),
        ("DQR-100007", "Balance or builder", "custom_sql", "c_acctbal",
         {"sql_expression": "c_acctbal > 100 OR c_mktsegment = 'BUILDING'"}, "warning", "hard",
         "c_acctbal > 100 OR c_mktsegment = 'BUILDING'"),
        ("DQR-100008", "E-mail given", "not_null", "c_email", {}, "error", "soft", None),
    ),
    {"nation": ("nation", "n_regionkey <> 1")},
)

ORDERS = Suite(
    "orders",
    "o_orderkey",
    {"o_orderpriority": ("nullif(o_orderpriority, '4-NOT SPECIFIED')", "nullif(o_orderpriority, '4-NOT SPECIFIED')")},
    (
        ("DQR-200001", "Priority given", "not_null", "o_orderpriority", {}, "error", "hard", "o_orderpriority IS NOT NULL"),
        ("DQR-200002", "Price range", "range", "o_totalprice", {"min": 5000, "max": 450000}, "error", "hard",
         "o_totalprice BETWEEN 5000 AND 450000"),
        ("DQR-200003", "Known status", "allowed_values", "o_orderstatus", {"values": ["F", "O"]}, "warning", "soft",
         "o_orderstatus IN ('F','O')"),
        ("DQR-200004", "Customer in good standing", "referential_integrity", "o_custkey",
         {"ref_table": "customer", "ref_column": "c_custkey"}, "error", "soft",
         "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"),
        ("DQR-200005", "Recent order", "freshness", "o_orderdate", {"max_age_hours": 26280}, "warning", "soft",
         "o_orderdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 26280 HOUR"),
        ("DQR-200006", "Unique order", "uniqueness", "o_orderkey", {"scope": "table"}, "error", "hard",
         "count(*) OVER (PARTITION BY o_orderkey) = 1"),
        ("DQR-200007", "Top priority", "regex", "o_orderpriority", {"pattern": "^[1-3]-"}, "info", "soft",
         "regexp_matches(o_orderpriority, '^[1-3]-')"),
        ("DQR-200008", "One order per customer and day", "uniqueness", "o_custkey",
         {"columns": ["o_custkey", "o_orderdate"]}, "warning", "soft",
         "count(*) OVER (PARTITION BY o_custkey, o_orderdate) = 1"),
    ),
    {"customer": ("customer", "c_acctbal > 0")},
)

LINEITEM = Suite(
    "lineitem",
    ("l_orderkey", "l_linenumber"),
    {},
    (
        ("DQR-300001", "Unique line", "uniqueness", "l_orderkey", {"columns": ["l_orderkey", "l_linenumber"]}, "error", "hard",
         "count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1"),
        ("DQR-300002", "Quantity limit", "range", "l_quantity", {"max": 45}, "warning", "soft", "l_quantity <= 45"),
        ("DQR-300003", "Return flag", "allowed_values", "l_returnflag", {"values": ["A", "N"]}, "warning", "soft",
         "l_returnflag IN ('A','N')"),
        ("DQR-300004", "Order settled", "referential_integrity", "l_orderkey",
         {"ref_table": "orders", "ref_column": "o_orderkey"}, "error", "hard",
         "l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"),
        ("DQR-300005", "Net price", "custom_sql", "l_extendedprice",
         {"sql_expression": "l_extendedprice * (1 - l_discount) > 2000"}, "info", "soft",
         "l_extendedprice * (1 - l_discount) > 2000"),
        ("DQR-300006", "Small part", "referential_integrity", "l_partkey",
         {"ref_table": "part", "ref_column": "p_partkey"}, "warning", "soft",
         "l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)"),
        ("DQR-300007", "Shipped lately", "freshness", "l_shipdate", {"max_age_hours": 20000}, "info", "soft",
         "l_shipdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 20000 HOUR"),
    ),
    {"orders": ("orders", "o_orderstatus <> 'P'"), "part": ("part", "p_size <= 40")},
)

PART = Suite(
    "part",
    "p_partkey",
    {},
    (
        ("DQR-400001", "Brand pattern", "regex", "p_brand", {"pattern": "^Brand#1?[0-9]$"}, "warning", "soft",
         "regexp_matches(p_brand, '^Brand#1?[0-9]$')"),
        ("DQR-400002", "Size range", "range", "p_size", {"min": 5, "max": 45}, "error", "hard", "p_size BETWEEN 5 AND 45"),
        ("DQR-400003", "Unique name and brand", "uniqueness", "p_name", {"columns": ["p_name", "p_brand"]}, "warning", "soft",
         "count(*) OVER (PARTITION BY p_name, p_brand) = 1"),
        ("DQR-400004", "Name length", "length", "p_name", {"min_length": 9, "max_length": 12}, "info", "soft",
         "length(p_name) BETWEEN 9 AND 12"),
        ("DQR-400005", "Known type", "allowed_values", "p_type", {"values": ["ECONOMY", "STANDARD", "PROMO"]}, "warning", "soft",
         "p_type IN ('ECONOMY','STANDARD','PROMO')"),
        ("DQR-400006", "Price given", "not_null", "p_retailprice", {}, "error", "hard", "p_retailprice IS NOT NULL"),
    ),
    {},
)

EVENTS = Suite(
    "events",
    "event_id",
    {},
    (
        ("DQR-500001", "Known event", "allowed_values", "event_type", {"values": ["view", "click", "purchase", "signup"]}, "error", "hard",
         "event_type IN ('view','click','purchase','signup')"),
        ("DQR-500002", "Value range", "range", "value", {"min": 1, "max": 100}, "warning", "soft", "value BETWEEN 1 AND 100"),
        ("DQR-500003", "Fresh event", "freshness", "ts", {"max_age_hours": 240}, "warning", "soft",
         "ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR"),
        ("DQR-500004", "Known user", "referential_integrity", "user_id",
         {"ref_table": "customer", "ref_column": "c_custkey"}, "error", "soft",
         "user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"),
        ("DQR-500005", "Unique user event", "uniqueness", "user_id", {"columns": ["user_id", "event_type", "value"]}, "warning", "soft",
         "count(*) OVER (PARTITION BY user_id, event_type, value) = 1"),
        ("DQR-500006", "Two-digit property", "regex", "props", {"pattern": '"k": [1-9][0-9]}'}, "info", "soft",
         "regexp_matches(props, '\"k\": [1-9][0-9]}')"),
    ),
    {"customer": ("customer", "c_acctbal > 0")},
)

DOCUMENTS = Suite(
    "documents",
    "doc_id",
    {},
    (
        ("DQR-600001", "Text length", "length", "text", {"min_length": 100, "max_length": 20000}, "error", "hard",
         "length(text) BETWEEN 100 AND 20000"),
        ("DQR-600002", "Unique text", "uniqueness", "text", {"scope": "table", "digest": True}, "error", "hard",
         "count(*) OVER (PARTITION BY text) = 1"),
        ("DQR-600003", "Known language", "allowed_values", "lang", {"values": ["en", "fr", "de"]}, "warning", "soft",
         "lang IN ('en','fr','de')"),
        ("DQR-600004", "Length as stated", "custom_sql", "n_chars", {"sql_expression": "n_chars = length(text)"}, "info", "soft",
         "n_chars = length(text)"),
        ("DQR-600005", "Labelled", "referential_integrity", "doc_id", {"ref_table": "labels", "ref_column": "doc_id"}, "warning", "soft",
         "doc_id IN (SELECT doc_id FROM labels)"),
        ("DQR-600006", "No address", "custom_sql", "text", {"sql_expression": "NOT text RLIKE '[a-z0-9.]+@[a-z0-9]+[.][a-z]+'"}, "error", "soft",
         "NOT regexp_matches(text, '[a-z0-9.]+@[a-z0-9]+[.][a-z]+')"),
    ),
    {"labels": ("labels", "true")},
)

CONVERSATIONS = Suite(
    "conversations",
    ("conv_id", "turn"),
    {},
    (
        ("DQR-700001", "Known role", "allowed_values", "role", {"values": ["user", "assistant"]}, "error", "hard",
         "role IN ('user','assistant')"),
        ("DQR-700002", "Unique turn", "uniqueness", "conv_id", {"columns": ["conv_id", "turn"]}, "error", "hard",
         "count(*) OVER (PARTITION BY conv_id, turn) = 1"),
        ("DQR-700003", "Turn length", "length", "text", {"min_length": 20}, "warning", "soft", "length(text) >= 20"),
        ("DQR-700004", "Early turn", "range", "turn", {"min": 0, "max": 4}, "info", "soft", "turn BETWEEN 0 AND 4"),
    ),
    {},
)

PAGES = Suite(
    "pages",
    "page_id",
    {},
    (
        ("DQR-800001", "Secure address", "regex", "url", {"pattern": "^https://"}, "warning", "soft", "regexp_matches(url, '^https://')"),
        ("DQR-800002", "Unique address", "uniqueness", "url", {"scope": "table"}, "error", "hard",
         "count(*) OVER (PARTITION BY url) = 1"),
        ("DQR-800003", "Page size", "length", "html", {"min_length": 500}, "warning", "soft", "length(html) >= 500"),
        ("DQR-800004", "Closed document", "custom_sql", "html", {"sql_expression": "html LIKE '%</html>%'"}, "error", "soft",
         "html LIKE '%</html>%'"),
    ),
    {},
)

SUITES = {s.name: s for s in (CUSTOMER, ORDERS, LINEITEM, PART, EVENTS, DOCUMENTS, CONVERSATIONS, PAGES)}

