"""Small tables with seeded defects, their rules, and the results expected of them.

Fixed values: the rows, rules, mappings and expected results below are test inputs stated as they are.
"""

import datetime as dt
import json

CUSTOMERS_SCHEMA = (
    "customer_id string, customer_name string, email string, age int, phone bigint, status string, "
    "country_code string, created_at date"
)
CUSTOMERS_CSV = """\
customer_id,customer_name,email,age,phone,status,country_code,created_at
C001,John Smith,john.smith@example.com,35,1234567890,active,US,2026-01-15
C002,Jane Doe,jane.doe@example.com,28,9876543210,active,UK,2026-01-20
C003,Bob Johnson,bob.johnson@example.com,45,5551234567,inactive,CA,2026-02-01
C004,,missing.name@example.com,30,4445556666,active,US,2026-02-10
C005,Alice Brown,invalid-email-format,25,7778889999,active,DE,2026-02-15
C006,Charlie Wilson,charlie@example.com,150,1112223333,suspended,FR,2026-02-20
C007,Diana Prince,diana@example.com,42,,active,XX,2026-03-01
C008,Eve Adams,,38,3334445555,active,US,2026-03-05
C009,Frank Castle,frank@example.com,17,6667778888,active,UK,2026-03-10
C010,Grace Lee,grace@example.com,55,12345,pending,JP,2026-03-15
C011,Henry Ford,henry@example.com,62,9998887777,deleted,US,2026-03-18
C012,Ivy Chen,ivy@example.com,29,8887776666,active,CN,2026-03-20
C013,Jack Ryan,jack@example.com,-5,7776665555,active,AU,2026-03-22
C014,Karen White,karen@@double.com,41,6665554444,active,US,2026-03-25
C015,Leo Messi,leo@example.com,38,5554443333123456,active,AR,2026-03-28
C001,John Smith Duplicate,john.dup@example.com,35,1234567890,active,US,2026-03-30
"""

TRANSACTIONS_SCHEMA = (
    "transaction_id string, customer_id string, amount double, transaction_type string, transaction_date date, "
    "quantity int, currency string, merchant string"
)
TRANSACTIONS_CSV = """\
transaction_id,customer_id,amount,transaction_type,transaction_date,quantity,currency,merchant
T001,C001,250.00,purchase,2026-03-30,2,USD,Amazon
T002,C002,1500.50,purchase,2026-03-30,1,GBP,Harrods
T003,C003,,refund,2026-03-29,1,CAD,BestBuy
T004,C001,75.25,transfer,2026-03-31,1,USD,PayPal
T005,C999,320.00,purchase,2026-03-28,3,USD,Walmart
T006,C005,45.99,invalid_type,2026-03-30,1,EUR,Zara
T007,C002,-100.00,purchase,2026-03-27,2,GBP,Tesco
T008,C004,2000000.00,purchase,2026-03-31,1,USD,Tesla
T009,C006,89.99,withdrawal,2026-03-30,1,EUR,ATM
T010,C001,150.00,deposit,,5,USD,BankTransfer
T011,C007,499.99,purchase,2026-03-31,0,USD,Apple
T012,C008,35.50,purchase,2026-03-30,-2,USD,Netflix
T013,C002,1250.00,purchase,2026-01-15,1,GBP,JohnLewis
T014,C010,67.80,purchase,2026-03-31,15000,JPY,Uniqlo
T015,C012,890.00,purchase,2026-03-30,3,CNY,Alibaba
"""

PRODUCTS_SCHEMA = (
    "product_id string, product_name string, sku string, price double, category string, stock_quantity int, "
    "supplier string, created_at date"
)
PRODUCTS_CSV = """\
product_id,product_name,sku,price,category,stock_quantity,supplier,created_at
P001,Wireless Mouse,ELC-1234,29.99,electronics,500,TechCorp,2026-01-01
P002,Running Shoes,SPT-5678,89.99,sports,200,NikeCo,2026-01-15
P003,,BKS-9012,15.99,books,1000,BookWorld,2026-02-01
P004,Organic Coffee,FOD-3456,12.50,food,300,FarmFresh,2026-02-15
P005,Standing Desk,FRN-7890,449.99,furniture,50,OfficePro,2026-03-01
P006,Smart Watch,ELC-2345,299.99,electronics,150,TechCorp,2026-03-05
P007,Yoga Mat,SPT-6789,-19.99,sports,400,FitGear,2026-03-10
P008,Building Blocks,TOY-1234,24.99,toys,600,ToyCo,2026-03-12
P009,Winter Jacket,CLT-4567,129.99,clothing,100,FashionHub,2026-03-15
P010,Mystery Novel,INVALID_SKU,9.99,books,800,BookWorld,2026-03-18
P011,Premium Steak,FOD-8901,150000.00,food,20,MeatKing,2026-03-20
P012,Gaming Chair,FRN-2345,349.99,gaming,75,OfficePro,2026-03-22
P013,Tennis Racket,SPT-3456,79.99,sports,90,FitGear,2026-03-25
P014,LED TV,ELC-1234,599.99,electronics,30,TechCorp,2026-03-28
P015,Cookbook,BKS-5678,22.99,books,250,BookWorld,2026-03-30
"""

COUNTRIES = ["US", "UK", "CA", "DE", "FR", "JP", "CN", "AU", "AR", "IN", "BR", "MX"]

AS_OF = "2026-04-01 00:00:00"

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# rule id, name, dataset, type, column, params, severity, mode, priority
RULES = [
    ("DQR-000001", "Customer Email Not Null", "customers", "not_null", "email", {}, "error", "hard", 1),
    ("DQR-000002", "Customer Name Not Null", "customers", "not_null", "customer_name", {}, "error", "hard", 2),
    ("DQR-000003", "Customer Age Range", "customers", "range", "age", {"min": 18, "max": 120}, "error", "soft", 3),
    ("DQR-000004", "Valid Email Format", "customers", "regex", "email", {"pattern": EMAIL}, "error", "soft", 4),
    ("DQR-000005", "Valid Phone Length", "customers", "length", "phone", {"min_length": 10, "max_length": 15}, "warning", "soft", 5),
    ("DQR-000006", "Customer Status Allowed Values", "customers", "allowed_values", "status", {"values": ["active", "inactive", "suspended", "pending"]}, "error", "hard", 6),
    ("DQR-000007", "Unique Customer ID", "customers", "uniqueness", "customer_id", {"scope": "table"}, "error", "hard", 7),
    ("DQR-000008", "Valid Country Code", "customers", "referential_integrity", "country_code", {"ref_table": "dim_country", "ref_column": "country_code"}, "warning", "soft", 8),
    ("DQR-000009", "Transaction Amount Not Null", "transactions", "not_null", "amount", {}, "error", "hard", 1),
    ("DQR-000010", "Transaction Amount Range", "transactions", "range", "amount", {"min": 0.01, "max": 1000000}, "error", "hard", 2),
    ("DQR-000011", "Valid Transaction Type", "transactions", "allowed_values", "transaction_type", {"values": ["purchase", "refund", "transfer", "withdrawal", "deposit"]}, "error", "hard", 3),
    ("DQR-000012", "Transaction Date Not Null", "transactions", "not_null", "transaction_date", {}, "error", "hard", 4),
    ("DQR-000013", "Valid Customer Reference", "transactions", "referential_integrity", "customer_id", {"ref_table": "customers", "ref_column": "customer_id"}, "error", "soft", 5),
    ("DQR-000014", "Transaction Freshness", "transactions", "freshness", "transaction_date", {"max_age_hours": 720}, "warning", "soft", 6),
    ("DQR-000015", "Positive Transaction Quantity", "transactions", "custom_sql", "quantity", {"sql_expression": "quantity > 0 AND quantity <= 10000"}, "warning", "soft", 7),
    ("DQR-000016", "Product Name Not Null", "products", "not_null", "product_name", {}, "error", "hard", 1),
    ("DQR-000017", "Product Price Range", "products", "range", "price", {"min": 0.01, "max": 99999.99}, "error", "hard", 2),
    ("DQR-000018", "Valid Product Category", "products", "allowed_values", "category", {"values": ["electronics", "clothing", "food", "furniture", "sports", "books", "toys"]}, "warning", "soft", 3),
    ("DQR-000019", "Product SKU Format", "products", "regex", "sku", {"pattern": "^[A-Z]{3}-[0-9]{4,6}$"}, "warning", "soft", 4),
    ("DQR-000020", "Unique Product SKU", "products", "uniqueness", "sku", {"scope": "table"}, "error", "hard", 5),
]

# rule id -> (keys failing in row mode, (total, failed, score) in sequential mode)
EXPECTED = {
    "DQR-000001": (["C008"], (16, 1, 93.75)),
    "DQR-000002": (["C004"], (15, 1, 93.33)),
    "DQR-000003": (["C006", "C009", "C013"], (14, 3, 78.57)),
    "DQR-000004": (["C005", "C008", "C014"], (14, 2, 85.71)),
    "DQR-000005": (["C007", "C010", "C015"], (14, 3, 78.57)),
    "DQR-000006": (["C011"], (14, 1, 92.86)),
    "DQR-000007": (["C001", "C001"], (13, 2, 84.62)),
    "DQR-000008": (["C007"], (11, 1, 90.91)),
    "DQR-000009": (["T003"], (15, 1, 93.33)),
    "DQR-000010": (["T003", "T007", "T008"], (14, 2, 85.71)),
    "DQR-000011": (["T006"], (12, 1, 91.67)),
    "DQR-000012": (["T010"], (11, 1, 90.91)),
    "DQR-000013": (["T005"], (10, 1, 90.00)),
    "DQR-000014": (["T010", "T013"], (10, 1, 90.00)),
    "DQR-000015": (["T011", "T012", "T014"], (10, 3, 70.00)),
    "DQR-000016": (["P003"], (15, 1, 93.33)),
    "DQR-000017": (["P007", "P011"], (14, 2, 85.71)),
    "DQR-000018": (["P012"], (12, 1, 91.67)),
    "DQR-000019": (["P010"], (12, 1, 91.67)),
    "DQR-000020": (["P001", "P014"], (12, 2, 83.33)),
}

# dataset -> rows, clean, all rules passed, passed evaluations, mean rule score and entries in sequential mode
EXPECTED_DATASETS = {
    "customers": (16, 11, 3, 113, 87.29, 14),
    "transactions": (15, 10, 5, 93, 87.37, 10),
    "products": (15, 10, 8, 68, 89.14, 7),
}

PRIMARY_KEYS = {"customers": "customer_id", "transactions": "transaction_id", "products": "product_id"}
SCHEMAS = {"customers": CUSTOMERS_SCHEMA, "transactions": TRANSACTIONS_SCHEMA, "products": PRODUCTS_SCHEMA}
CSVS = {"customers": CUSTOMERS_CSV, "transactions": TRANSACTIONS_CSV, "products": PRODUCTS_CSV}


def rule_entries(dataset):
    """Resolved rules of a dataset as plain rows."""
    names = ("rule_id", "rule_name", "dataset", "rule_type", "column", "params", "severity", "enforcement", "priority")
    return [dict(zip(names, r)) for r in RULES if r[2] == dataset]


def catalogue_json():
    """The rules and mappings as the governance catalogue delivers them."""
    rules, mappings = [], []
    for i, (rid, name, dataset, kind, column, params, severity, mode, priority) in enumerate(RULES, 1):
        rules.append(
            {
                "rule_id": rid, "rule_name": name, "rule_type": kind, "column": column, "params": params,
                "severity": severity, "is_active": True, "version": 1, "effective_from": "2026-01-01",
                "effective_to": None, "description": name, "owner": "stewards",
            }
        )
        mappings.append(
            {
                "mapping_id": f"MAP-{i:03d}", "dataset_name": f"bronze.{dataset}", "column_name": column,
                "rule_id": rid, "enforcement_mode": mode, "priority": priority, "is_active": True,
            }
        )
    return json.dumps({"rules": rules}, indent=1), json.dumps({"mappings": mappings}, indent=1)


def moment(text):
    return dt.datetime.fromisoformat(text)
