"""Declared schemas, as DDL text. Jobs read with these and never infer a schema."""

from __future__ import annotations

TABLES: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

ACCOUNTS = "id BIGINT, owner_id BIGINT, currency STRING, balance_minor BIGINT, version BIGINT"
PAYMENTS = "id BIGINT, account_id BIGINT, amount_minor BIGINT, status STRING, created_at TIMESTAMP_NTZ"
LEDGER = "id BIGINT, account_id BIGINT, payment_id BIGINT, amount_minor BIGINT, created_at TIMESTAMP_NTZ"
TRANSFERS = (
    "transfer_id STRING, idempotency_key STRING, from_account BIGINT, to_account BIGINT, amount_minor BIGINT"
)
REQUESTS = (
    "seq BIGINT, idempotency_key STRING, from_account BIGINT, to_account BIGINT, amount_minor BIGINT, actor STRING"
)

# fixed values: the closed lists and patterns of the data model; \z, since $ would let a last line feed through
PAYMENT_STATUSES = ["PENDING", "COMPLETED", "FAILED"]
OPERATION_STATUSES = ["RESERVED", "COMPLETED", "FAILED"]
JOB_STATUSES = ["READY", "DONE"]
CURRENCY_PATTERN = r"^[A-Z]{3}\z"
SAFE_ID_PATTERN = r"^[A-Za-z0-9._:-]+\z"
KEY_MAX_LENGTH = 128
