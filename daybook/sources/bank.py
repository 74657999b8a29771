"""Bank-shaped source tables, as views over the given TPC-H-like and event tables.

Each view reads its whole base table. Placeholders in braces name the tables a view
needs. The text is plain SQL, so Spark and the DuckDB oracle read the same definitions.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from daybook.sources.schemas import SOURCE_SCHEMAS
from daybook.sources.tables import TableSet

VIEWS: dict[str, str] = {
    "institution": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE WHEN n_nationkey NOT IN (0, 7, 14, 21) THEN CAST(n_regionkey AS BIGINT) END AS company_id
        FROM {nation}""",
    "company": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM {region}",
    "role": """
        SELECT CAST(r_regionkey AS BIGINT) AS id,
               CASE WHEN r_name IN ('AMERICA', 'ASIA', 'EUROPE') THEN 'MEMBER' ELSE 'STAFF' END AS type
        FROM {region}""",
    "sub_role": "SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS role_id FROM {nation}",
    "member": """
        SELECT c_custkey AS id,
               CAST(c_nationkey AS BIGINT) AS sub_role_id,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' OR c_acctbal > 500 THEN CAST(c_nationkey AS BIGINT) END AS institution_id,
               DATE '2020-01-01' + CAST(c_nationkey AS INT) AS created_at,
               CASE WHEN c_acctbal < 0 THEN DATE '2023-01-01' + CAST(c_nationkey AS INT) END AS deleted_at
        FROM {customer}""",
    "account": "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS institution_id FROM {customer}",
    "ownership_type": """
        SELECT CAST(r_regionkey AS BIGINT) + 1 AS id, r_name AS key,
               CASE WHEN r_regionkey < 3 THEN 'MEMBER' ELSE 'ORGANIZATION' END AS type
        FROM {region}""",
    "member_account": """
        SELECT o_orderkey AS id, o_custkey AS member_id, o_custkey AS account_id,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS ownership_type_id,
               o_orderstatus = 'P' AS is_primary,
               o_orderdate AS created_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS deleted_at
        FROM {orders}""",
    "account_type": "SELECT CAST(r_regionkey AS BIGINT) + 1 AS id, r_name AS value FROM {region}",
    "loan": """
        SELECT s_suppkey AS id,
               CASE WHEN s_nationkey IN (3, 11) THEN -1 - s_suppkey ELSE s_suppkey END AS account_id,
               CASE WHEN s_nationkey < 5 THEN CAST(9 AS BIGINT) WHEN s_nationkey < 15 THEN 1 ELSE 2 END AS account_type_id,
               s_acctbal AS current_balance,
               CAST(DATE '2019-01-01' + CAST(s_nationkey AS INT) AS TIMESTAMP) AS created_at,
               CASE WHEN s_acctbal < 1000 THEN CAST(DATE '2023-01-01' + CAST(s_nationkey AS INT) AS TIMESTAMP) END AS deleted_at
        FROM {supplier}""",
    "subaccount": """
        SELECT c_custkey AS id,
               CASE WHEN c_nationkey IN (3, 11) THEN -1 - c_custkey ELSE c_custkey END AS account_id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN CAST(1 AS BIGINT) WHEN 'BUILDING' THEN 2
                    WHEN 'FURNITURE' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE 9 END AS account_type_id,
               c_acctbal AS amount,
               DATE '2020-01-01' + CAST(c_nationkey AS INT) AS created_at,
               CASE WHEN c_acctbal < 0 THEN DATE '2023-01-01' + CAST(c_nationkey AS INT) END AS deleted_at
        FROM {customer}""",
    "loan_txn": """
        SELECT l_suppkey AS loan_id,
               CAST(l_shipdate AS DATE) AS date,
               l_shipdate AS created_at,
               l_orderkey * 10 + l_linenumber AS seq,
               CASE WHEN l_quantity >= 3 THEN l_extendedprice END AS balance,
               CASE WHEN l_returnflag = 'R' THEN 'PENDING' END AS status,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN l_shipdate END AS deleted_at
        FROM {lineitem}""",
    "subaccount_txn": """
        SELECT user_id AS subaccount_id,
               CAST(ts AS DATE) AS date,
               ts AS created_at,
               event_id AS seq,
               value AS balance,
               CASE WHEN event_type = 'error' THEN 'PENDING' END AS status,
               CASE WHEN event_type = 'view' THEN ts END AS deleted_at
        FROM {events}""",
    "external_subaccount": "SELECT p_partkey AS id, p_name AS name, p_retailprice AS amount FROM {part}",
    "external_subaccount_member": """
        SELECT DISTINCT l_partkey AS external_subaccount_id, l_suppkey AS member_id FROM {lineitem}""",
    "txn_info": "SELECT event_id AS id, props AS details FROM {events}",
    "txn_category": "SELECT DISTINCT event_type AS id, upper(event_type) AS name FROM {events}",
    "member_status": """
        SELECT o_orderstatus AS id, o_orderstatus = 'P' AS open,
               max(o_orderdate) AS last_used, max(o_totalprice) AS largest
        FROM {orders} GROUP BY o_orderstatus""",
}


def base_tables(view: str) -> list[str]:
    """Given tables one view reads."""
    return sorted({field for _, field, _, _ in Formatter().parse(VIEWS[view]) if field})


def portable_sql(view: str) -> str:
    """The view's text with plain table names, as the oracle runs it."""
    return VIEWS[view].format(**{name: name for name in base_tables(view)}).strip()


def _spark_sql(view: str) -> str:
    # The given timestamps carry no zone; Spark's bare TIMESTAMP does.
    return re.sub(r"AS TIMESTAMP\)", "AS TIMESTAMP_NTZ)", VIEWS[view])


def bank_tables(spark: SparkSession, directory: str) -> TableSet:
    """Lazy bank tables over the Parquet files of one directory, refused where they do not fit their declared schema."""
    base = TableSet.from_directory(spark, directory)

    def define(view: str) -> DataFrame:
        return spark.sql(_spark_sql(view), **{name: base[name] for name in base_tables(view)})

    return TableSet(define, lambda: sorted(VIEWS)).checked(SOURCE_SCHEMAS)
