"""SQL counterparts of the named queries, for DuckDB over the same Parquet tables.

They are written in the plain shape - entities x days, joins, running windows - and share with the
Spark side only the definitions of the bank tables and the parameters.
"""

from __future__ import annotations

import re

from daybook import catalogue as cat
from daybook.sources.bank import VIEWS, portable_sql

RUN_TS = f"TIMESTAMP '{cat.RUN.run_ts:%Y-%m-%d %H:%M:%S}'"
CLIENT = f"CAST({cat.RUN.client_id} AS INTEGER)"
CLIENT_TEXT = f"'{cat.RUN.client_id}'"
NO_TS = "CAST(NULL AS TIMESTAMP)"
NO_TEXT = "CAST(NULL AS VARCHAR)"
AUDIT = f"{RUN_TS} AS first_uploaded, {NO_TS} AS last_uploaded"


def _with(body: str, **parts: str) -> str:
    """Prefix a query with the bank tables it names and with further named parts."""
    text = " ".join([body, *parts.values()])
    views = {v: portable_sql(v) for v in VIEWS if re.search(rf"\b(FROM|JOIN)\s+{v}\b", text)}
    named = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in {**views, **parts}.items())
    return f"WITH {named}\n{body}" if named else body


def _status(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END"


# First day of each ledger's series; the last is the ledger's last day with any transaction.
STARTS = {"loan_txn": cat.LOAN_START, "subaccount_txn": cat.DEPOSIT_START}


def _days(txns: str) -> str:
    start = f"TIMESTAMP '{STARTS[txns]}'"
    return (
        f"SELECT CAST(d AS DATE) AS date FROM generate_series({start}, "
        f"greatest({start}, coalesce((SELECT CAST(max(date) AS TIMESTAMP) FROM {txns}), {start})), INTERVAL 1 DAY) AS g(d)"
    )


def _posted(table: str) -> str:
    return f"SELECT * FROM {table} WHERE status IS NULL AND deleted_at IS NULL"


def _whole_ledgers(balance: str) -> str:
    ledgers = "\nUNION ALL\n".join(
        f"SELECT '{ledger.txns}' AS ledger, {ledger.txn_holder} AS holder, date, created_at, seq, "
        f"CAST(balance AS DECIMAL(18,2)) AS balance FROM {ledger.txns} WHERE status IS NULL AND deleted_at IS NULL"
        for ledger in (cat.LOANS, cat.DEPOSITS)
    )
    return (
        f"SELECT ledger, holder, date, created_at, seq, CAST({balance} AS DECIMAL(18,2)) AS balance FROM ({ledgers}) "
        "WINDOW so_far AS (PARTITION BY ledger ORDER BY date NULLS LAST, created_at NULLS LAST, seq NULLS LAST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


def _last_per_day(source: str, holder: str, money: str = "CAST(balance AS DECIMAL(18,2))") -> str:
    return f"""SELECT {holder}, date, balance FROM (
  SELECT {holder}, date, {money} AS balance,
         row_number() OVER (PARTITION BY {holder}, date
           ORDER BY created_at DESC NULLS LAST, seq DESC NULLS LAST, balance DESC NULLS LAST) AS rn
  FROM {source}) AS ranked WHERE rn = 1"""


def _spine(source: str, holder: str, txns: str) -> str:
    return (
        f"SELECT e.{holder}, d.date FROM (SELECT DISTINCT {holder} FROM {source}) AS e "
        f"CROSS JOIN ({_days(txns)}) AS d"
    )


_FILLS = {
    "last": "last_value(l.balance IGNORE NULLS)",
    "max": "max(l.balance)",
}


def _series(spine: str, last: str, holder: str, fill: str, zero: str) -> str:
    frame = f"OVER (PARTITION BY s.{holder} ORDER BY s.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""SELECT s.{holder}, s.date, coalesce(l.balance, {_FILLS[fill]} {frame}, {zero}) AS balance
FROM {spine} AS s LEFT JOIN {last} AS l ON l.{holder} = s.{holder} AND l.date = s.date"""


ZERO_MONEY = "CAST(0 AS DECIMAL(18,2))"

# Parts of the balance facts, per ledger; the audit's count all transactions and keep doubles.
LOAN_PARTS = {
    "loan_posted": _posted("loan_txn"),
    "loan_last": _last_per_day("loan_posted", "loan_id"),
    "loan_spine": _spine("loan_posted", "loan_id", "loan_txn"),
    "loan_series": _series("loan_spine", "loan_last", "loan_id", "last", ZERO_MONEY),
}
DEPOSIT_PARTS = {
    "sub_posted": _posted("subaccount_txn"),
    "sub_last": _last_per_day("sub_posted", "subaccount_id"),
    "sub_spine": _spine("sub_posted", "subaccount_id", "subaccount_txn"),
    "sub_series": _series("sub_spine", "sub_last", "subaccount_id", "last", ZERO_MONEY),
}
AUDIT_PARTS = {
    "loan_last_all": _last_per_day("loan_txn", "loan_id", "balance"),
    "loan_spine_all": _spine("loan_txn", "loan_id", "loan_txn"),
    "loan_max": _series("loan_spine_all", "loan_last_all", "loan_id", "max", "CAST(0 AS DOUBLE)"),
    "sub_last_all": _last_per_day("subaccount_txn", "subaccount_id", "balance"),
    "sub_spine_all": _spine("subaccount_txn", "subaccount_id", "subaccount_txn"),
    "sub_max": _series("sub_spine_all", "sub_last_all", "subaccount_id", "max", "CAST(0 AS DOUBLE)"),
}


def _fact(series: str, holder: str, prefix: str, holders: str) -> str:
    return f"""SELECT '{prefix}' || CAST(s.{holder} AS VARCHAR) AS subaccount_id,
       'INT' || CAST(h.account_id AS VARCHAR) AS account_id,
       {CLIENT} AS client_id, CAST(a.institution_id AS VARCHAR) AS company_id, s.date,
       s.balance AS current_balance, CAST(NULL AS DECIMAL(18,2)) AS available_balance, {AUDIT}
FROM {series} AS s LEFT JOIN {holders} AS h ON h.id = s.{holder} LEFT JOIN account AS a ON a.id = h.account_id"""


def _audit_fact(series: str, holder: str, prefix: str, holders: str) -> str:
    return f"""SELECT '{prefix}' || CAST(s.{holder} AS VARCHAR) AS subaccount_id,
       'INT' || CAST(h.account_id AS VARCHAR) AS account_id,
       {CLIENT} AS client_id, a.institution_id AS company_id, s.date, s.balance
FROM {series} AS s LEFT JOIN {holders} AS h ON h.id = s.{holder} LEFT JOIN account AS a ON a.id = h.account_id"""


FACT_LOAN = _fact("loan_series", "loan_id", "LOAN", "loan")
FACT_SUB = _fact("sub_series", "subaccount_id", "SUB", "subaccount")
FACT = f"{FACT_LOAN}\nUNION ALL\n{FACT_SUB}"
FACT_PARTS = {**LOAN_PARTS, **DEPOSIT_PARTS}
AUDIT_FACT = (
    _audit_fact("loan_max", "loan_id", "LOAN", "loan")
    + "\nUNION ALL\n"
    + _audit_fact("sub_max", "subaccount_id", "SUB", "subaccount")
)

# What held before the series: the value of the last earlier day whose last transaction has one.
def _opened(series: str, last: str, holder: str, start: str) -> str:
    opening = f"SELECT {holder}, arg_max(balance, date) AS opening FROM {last} WHERE date < DATE '{start}' AND balance IS NOT NULL GROUP BY {holder}"
    first = f"SELECT {holder}, min(date) AS first FROM {last} WHERE date >= DATE '{start}' AND balance IS NOT NULL GROUP BY {holder}"
    return f"""SELECT s.{holder}, s.date, CASE WHEN f.first IS NULL OR s.date < f.first THEN coalesce(o.opening, s.balance)
  ELSE s.balance END AS balance
FROM {series} AS s LEFT JOIN ({opening}) AS o ON o.{holder} = s.{holder} LEFT JOIN ({first}) AS f ON f.{holder} = s.{holder}"""


CARRIED_PARTS = {
    **FACT_PARTS,
    "loan_carried": _opened("loan_series", "loan_last", "loan_id", cat.LOAN_START),
    "sub_carried": _opened("sub_series", "sub_last", "subaccount_id", cat.DEPOSIT_START),
}
FACT_CARRIED = (
    _fact("loan_carried", "loan_id", "LOAN", "loan") + "\nUNION ALL\n" + _fact("sub_carried", "subaccount_id", "SUB", "subaccount")
)

ACCOUNT_DAYS = """SELECT account_id, company_id, date, sum(current_balance) AS balance FROM fact
WHERE account_id IS NOT NULL GROUP BY account_id, company_id, date"""
MEMBER_DAYS = """SELECT l.member_id, l.company_id, d.date, sum(d.balance) AS balance
FROM (SELECT DISTINCT member_id, company_id, account_id FROM known WHERE status = 'ACTIVE') AS l
  JOIN account_days AS d ON d.account_id = l.account_id GROUP BY l.member_id, l.company_id, d.date"""


def _summary(owner: str, days: str) -> str:
    return (
        f"SELECT {owner}, {CLIENT} AS client_id, company_id, date, CAST(balance AS DECIMAL(28,2)) AS current_balance, {AUDIT} FROM {days}"
    )


COMPANY = f"""SELECT CAST(i.id AS VARCHAR) AS company_id, {CLIENT} AS client_id, c.name, {NO_TEXT} AS config,
       CAST(i.company_id AS VARCHAR) AS parent_company_id, {AUDIT}
FROM institution AS i LEFT JOIN company AS c ON c.id = i.company_id"""

MEMBER = f"""SELECT CAST(m.id AS VARCHAR) AS member_id, {CLIENT} AS client_id,
       CAST(m.institution_id AS VARCHAR) AS company_id, {_status("m.deleted_at")} AS status,
       CAST(m.created_at AS TIMESTAMP) AS created_at, CAST(m.deleted_at AS TIMESTAMP) AS deleted_at, {AUDIT}
FROM member AS m LEFT JOIN sub_role AS s ON s.id = m.sub_role_id LEFT JOIN role AS r ON r.id = s.role_id
WHERE r.type = 'MEMBER'"""

ACCOUNT = f"""SELECT 'INT' || CAST(id AS VARCHAR) AS account_id, CAST(institution_id AS VARCHAR) AS company_id,
       {CLIENT} AS client_id, 'Internal' AS internal_external, {AUDIT}
FROM account"""

BRIDGE = f"""SELECT CAST(ma.id AS VARCHAR) AS member_account_id, {CLIENT} AS client_id,
       CAST(m.institution_id AS VARCHAR) AS company_id, CAST(ma.member_id AS VARCHAR) AS member_id,
       'INT' || CAST(ma.account_id AS VARCHAR) AS account_id, o.key AS ownership_type, ma.is_primary,
       {_status("ma.deleted_at")} AS status, ma.created_at, ma.deleted_at, {AUDIT}
FROM member_account AS ma LEFT JOIN ownership_type AS o ON o.id = ma.ownership_type_id
     LEFT JOIN member AS m ON m.id = ma.member_id
WHERE o.type = 'MEMBER'"""

BRIDGE_KNOWN = """SELECT b.* FROM bridge AS b WHERE EXISTS (
  SELECT 1 FROM members AS d
  WHERE d.member_id = b.member_id AND d.client_id = b.client_id AND d.company_id = b.company_id)"""
BRIDGE_PARTS = {"bridge": BRIDGE, "members": MEMBER}


def _subaccount(prefix: str, holders: str, amount: str, side: str) -> str:
    return f"""SELECT '{prefix}' || CAST(h.id AS VARCHAR) AS subaccount_id,
       'INT' || CAST(h.account_id AS VARCHAR) AS account_id, {CLIENT} AS client_id,
       CAST(a.institution_id AS VARCHAR) AS company_id, c.name AS company_name,
       'Internal' AS internal_or_external, t.value AS default_type, '' AS custom_type,
       '{side}' AS default_asset_liability, '' AS custom_asset_liability, {_status("h.deleted_at")} AS status,
       CAST(h.{amount} AS DECIMAL(18,2)) AS current_balance, CAST(NULL AS DECIMAL(18,2)) AS available_balance,
       CAST(h.created_at AS TIMESTAMP) AS created_at, CAST(h.deleted_at AS TIMESTAMP) AS deleted_at, {AUDIT}
FROM {holders} AS h LEFT JOIN account_type AS t ON t.id = h.account_type_id
     LEFT JOIN account AS a ON a.id = h.account_id LEFT JOIN institution AS i ON i.id = a.institution_id
     LEFT JOIN company AS c ON c.id = i.company_id"""


SUBACCOUNT_LOAN = _subaccount("LOAN", "loan", "current_balance", "liability")
SUBACCOUNT_SUB = _subaccount("SUB", "subaccount", "amount", "asset")
SUBACCOUNT = f"{SUBACCOUNT_LOAN}\nUNION ALL\n{SUBACCOUNT_SUB}"

AUDIT_COMPANY = f"""SELECT i.id AS company_id, {CLIENT_TEXT} AS client_id, c.name
FROM institution AS i LEFT JOIN company AS c ON c.id = i.company_id"""
AUDIT_MEMBER = f"""SELECT m.id AS member_id, m.institution_id AS company_id, {CLIENT_TEXT} AS client_id,
       m.created_at, m.deleted_at, {_status("m.deleted_at")} AS status
FROM member AS m LEFT JOIN sub_role AS s ON s.id = m.sub_role_id LEFT JOIN role AS r ON r.id = s.role_id
WHERE r.type = 'MEMBER'"""
AUDIT_ACCOUNT = f"""SELECT 'INT' || CAST(id AS VARCHAR) AS account_id, institution_id AS company_id,
       {CLIENT_TEXT} AS client_id, 'Internal' AS internal_external FROM account"""
AUDIT_BRIDGE = f"""SELECT ma.member_id, ma.account_id, m.institution_id AS company_id, {CLIENT_TEXT} AS client_id,
       o.key AS ownership_type, ma.is_primary, {_status("ma.deleted_at")} AS status, ma.created_at, ma.deleted_at
FROM member_account AS ma LEFT JOIN ownership_type AS o ON o.id = ma.ownership_type_id
     LEFT JOIN member AS m ON m.id = ma.member_id
WHERE o.type = 'MEMBER'"""


def _audit_subaccount(prefix: str, holders: str, amount: str, side: str) -> str:
    return f"""SELECT '{prefix}' || CAST(h.id AS VARCHAR) AS subaccount_id,
       'INT' || CAST(h.account_id AS VARCHAR) AS account_id, {CLIENT_TEXT} AS client_id,
       a.institution_id AS company_id, c.name AS company_name, 'Internal' AS internal_or_external,
       {_status("h.deleted_at")} AS status, t.value AS default_type, '' AS custom_type,
       '{side}' AS default_asset_liability, '' AS custom_asset_liability, h.{amount} AS current_balance,
       CAST(h.created_at AS TIMESTAMP) AS created_at, CAST(h.deleted_at AS TIMESTAMP) AS deleted_at
FROM {holders} AS h LEFT JOIN account_type AS t ON t.id = h.account_type_id
     LEFT JOIN account AS a ON a.id = h.account_id LEFT JOIN institution AS i ON i.id = a.institution_id
     LEFT JOIN company AS c ON c.id = i.company_id"""


AUDIT_SUBACCOUNT = (
    _audit_subaccount("LOAN", "loan", "current_balance", "liability")
    + "\nUNION ALL\n"
    + _audit_subaccount("SUB", "subaccount", "amount", "asset")
)


def _reconcile(actual: str, expected: str, keys: list[str], columns: list[str], label: str = "") -> str:
    """Full outer join of both sides, each reduced to one row per key with its number of rows."""

    def side(name: str) -> str:
        picked = ", ".join([*keys, *(f"max({c}) AS {c}" for c in columns), "count(*) AS copies"])
        return f"(SELECT {picked} FROM {name} GROUP BY {', '.join(keys)})"

    match = " AND ".join(f"a.{k} IS NOT DISTINCT FROM e.{k}" for k in keys)
    joined = f"{side(actual)} AS a FULL JOIN {side(expected)} AS e ON {match}"
    single = "a.copies = 1 AND e.copies = 1"
    measures = {
        ("missing", None): "a.copies IS NULL",
        ("unexpected", None): "e.copies IS NULL",
        ("duplicate", None): "a.copies > 1 OR e.copies > 1",
        ("compared", None): single,
        **{("mismatch", c): f"{single} AND a.{c} IS DISTINCT FROM e.{c}" for c in columns},
    }
    prefix = f"'{label}' AS dataset, " if label else ""
    return "\nUNION ALL\n".join(
        f"SELECT {prefix}'{metric}' AS metric, "
        + (f"'{column}'" if column else NO_TEXT)
        + f" AS column_name, count(*) FILTER (WHERE {condition}) AS n FROM {joined}"
        for (metric, column), condition in measures.items()
    )


RECONCILE_PARTS = {
    "built_company": COMPANY,
    "audited_company": f"SELECT * REPLACE (CAST(company_id AS VARCHAR) AS company_id) FROM ({AUDIT_COMPANY})",
    "built_member": MEMBER,
    "audited_member": "SELECT * REPLACE (CAST(member_id AS VARCHAR) AS member_id, "
    f"CAST(company_id AS VARCHAR) AS company_id) FROM ({AUDIT_MEMBER})",
    "built_account": ACCOUNT,
    "audited_account": f"SELECT * REPLACE (CAST(company_id AS VARCHAR) AS company_id) FROM ({AUDIT_ACCOUNT})",
    "built_subaccount": SUBACCOUNT,
    "audited_subaccount": "SELECT * REPLACE (CAST(company_id AS VARCHAR) AS company_id, "
    f"CAST(current_balance AS DECIMAL(18,2)) AS current_balance) FROM ({AUDIT_SUBACCOUNT})",
    **BRIDGE_PARTS,
    "built_bridge": BRIDGE_KNOWN,
    "audited_bridge": "SELECT * REPLACE (CAST(member_id AS VARCHAR) AS member_id, "
    "CAST(company_id AS VARCHAR) AS company_id, 'INT' || CAST(account_id AS VARCHAR) AS account_id) "
    f"FROM ({AUDIT_BRIDGE})",
}
RECONCILED = {
    "company": (["company_id"], ["name"]),
    "member": (["member_id"], ["company_id", "status"]),
    "account": (["account_id"], ["company_id", "internal_external"]),
    "subaccount": (
        ["subaccount_id"],
        ["account_id", "company_id", "company_name", "default_type", "status", "current_balance"],
    ),
    "bridge": (
        ["member_id", "account_id", "created_at", "ownership_type", "status", "is_primary"],
        ["company_id"],
    ),
}


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

def _copy_and_changes() -> dict[str, str]:
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ("o_orderdate", *ORDER_COLUMNS))
    return {
        "copy": "SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'",
        "versions": "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice, "
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority) "
        "FROM orders WHERE o_orderdate >= DATE '1997-01-01'",
        "all_versions": "SELECT * FROM versions UNION ALL SELECT * REPLACE (o_totalprice + 100 AS o_totalprice, "
        "o_orderdate - INTERVAL 1 DAY AS o_orderdate) FROM versions WHERE o_orderstatus = 'F'",
        "keyless": "SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_orderkey) FROM versions WHERE o_orderpriority = '1-URGENT'",
        "changes": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY o_orderkey ORDER BY {newest}) AS rn FROM all_versions) WHERE rn = 1 UNION ALL SELECT * FROM keyless",
    }


UPSERT = (
    "SELECT "
    + ", ".join(f"CASE WHEN s.o_custkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ORDER_COLUMNS)
    + " FROM copy AS t FULL JOIN changes AS s ON s.o_orderkey = t.o_orderkey"
)
INSERT_IF_ABSENT = (
    "SELECT * FROM copy UNION ALL SELECT * FROM keyless UNION ALL SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_orderkey ORDER BY o_orderdate, "
    + ", ".join(f"{c} NULLS FIRST" for c in ORDER_COLUMNS)
    + ") AS rn FROM all_versions AS s WHERE NOT EXISTS (SELECT 1 FROM copy AS t WHERE t.o_orderkey = s.o_orderkey)) WHERE rn = 1"
)

# Columns of each dictionary beside id, with the text a reader sees.
_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S')"
DICTIONARY_COLUMNS: dict[str, dict[str, str]] = {
    "ownership_type": {"key": "key", "type": "type"},
    "account_type": {"value": "value"},
    "member_status": {
        "open": "CAST(open AS VARCHAR)",
        "last_used": _ISO.format(c="last_used"),
        "largest": "CAST(largest AS VARCHAR)",
    },
    "txn_category": {"name": "name"},
    "role": {"type": "type"},
    "sub_role": {"role_id": "CAST(role_id AS VARCHAR)"},
    "company": {"name": "name"},
}


def _dictionary_attributes() -> str:
    parts = []
    for table, columns in DICTIONARY_COLUMNS.items():
        texts = {"source_id": "CAST(id AS VARCHAR)", "source_table": f"'{table}'", **columns}
        for attribute, text in texts.items():
            parts.append(
                f"SELECT '{table}' || CAST(id AS VARCHAR) AS id, '{attribute}' AS attribute, {text} AS value "
                f"FROM {table} WHERE {text} IS NOT NULL"
            )
    return "\nUNION ALL\n".join(parts)


# Numbers and booleans, which JSON shows without quotes.
DICTIONARY_BARE = {("member_status", "open"), ("member_status", "largest"), ("sub_role", "role_id")}


def _json_text(text: str) -> str:
    return f"to_json(CAST({text} AS VARCHAR))"


def _dictionary_items() -> str:
    """JSON text with the columns in their order; text is quoted, numbers and booleans are not, nulls are left out."""
    parts = []
    for table, columns in DICTIONARY_COLUMNS.items():
        fields = ", ".join(
            f"'\"{c}\":' || {text if (table, c) in DICTIONARY_BARE else _json_text(text)}" for c, text in columns.items()
        )
        parts.append(
            f"SELECT '{table}' || CAST(id AS VARCHAR) AS id, CAST(id AS VARCHAR) AS source_id, '{table}' AS source_table, "
            f"'{{' || concat_ws(',', {fields}) || '}}' AS attributes FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


def _counts(tables: list[str], where: str = "") -> str:
    return "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}{where}" for t in tables)


GIVEN_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
POSTED_ONLY = " WHERE status IS NULL AND deleted_at IS NULL"


def _audit_rows() -> tuple[str, dict[str, str]]:
    """Constraint audit over the built tables, each as a named part."""
    parts = {
        "t_client": f"SELECT {CLIENT} AS client_id",
        "t_calendar": "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id, CAST(d AS DATE) AS full_date, "
        "day(d) AS day, month(d) AS month, year(d) AS year "
        f"FROM generate_series({RUN_TS} - INTERVAL 2 YEAR, {RUN_TS} + INTERVAL 2 YEAR, INTERVAL 1 DAY) AS g(d)",
        "t_company": COMPANY,
        "t_member": MEMBER,
        "t_account": ACCOUNT,
        "t_subaccount": SUBACCOUNT,
        **BRIDGE_PARTS,
        "t_bridge": BRIDGE_KNOWN,
        **FACT_PARTS,
        "t_fact": FACT,
        "t_transactions": "SELECT CAST(NULL AS VARCHAR) AS transaction_id, "
        f"{CLIENT} AS client_id, CAST(NULL AS VARCHAR) AS company_id WHERE false",
    }
    alias = {
        "dim_client": "t_client",
        "dim_calendar": "t_calendar",
        "dim_company": "t_company",
        "dim_member": "t_member",
        "dim_account": "t_account",
        "dim_subaccount": "t_subaccount",
        "bridge_member_account": "t_bridge",
        "fact_balance_subaccount": "t_fact",
        "fact_transactions": "t_transactions",
    }
    rows = []
    for name, target in cat.TARGETS.items():
        table = alias[name]

        def report(kind: str, columns: str, count: str) -> None:
            rows.append(f"SELECT '{name}' AS target, '{kind}' AS kind, '{columns}' AS columns, ({count}) AS broken")

        for c in target.not_null:
            report("not_null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL")
        key = ", ".join(target.key)
        nulls = " OR ".join(f"{c} IS NULL" for c in target.key)
        keys = f"SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1 OR {nulls}"
        report("primary_key", ",".join(target.key), f"SELECT count(*) FROM ({keys})")
        for c in target.unique:
            repeated = f"SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
            report("unique", c, f"SELECT count(*) FROM ({repeated})")
        for ref in target.references:
            filled = " AND ".join(f"c.{c} IS NOT NULL" for c in ref.columns)
            match = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(ref.columns, ref.parent_columns))
            report(
                f"foreign_key:{ref.parent}",
                ",".join(ref.columns),
                f"SELECT count(*) FROM {table} AS c WHERE {filled} "
                f"AND NOT EXISTS (SELECT 1 FROM {alias[ref.parent]} AS p WHERE {match})",
            )
    return "\nUNION ALL\n".join(rows), parts


def _empty(kind: str, *names: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names)


def oracles() -> dict[str, str]:
    """Query name to SQL."""
    audit_body, audit_parts = _audit_rows()
    dim_bridge = _with(BRIDGE_KNOWN, **BRIDGE_PARTS)
    required = ["subaccount_id", "account_id", "client_id", "company_id"]
    missing = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required) + ")"
    return {
        "scan_source": "SELECT * FROM orders",
        "ingest_select": _with(
            _counts(list(cat.REPLICATED)) + "\nUNION ALL\n" + _counts(list(cat.TXN_TABLES), POSTED_ONLY)
        ),
        "ingest_wildcard": _counts(GIVEN_TABLES),
        "ingest_null_filters": _with(
            "SELECT 'loan_txn' AS table_name, loan_id AS holder, date, seq, balance FROM loan_txn" + POSTED_ONLY
            + " UNION ALL SELECT 'subaccount_txn' AS table_name, subaccount_id AS holder, date, seq, balance "
            "FROM subaccount_txn" + POSTED_ONLY
        ),
        "date_spine": _with(
            "SELECT CAST(d AS DATE) AS date FROM generate_series((SELECT CAST(min(date) AS TIMESTAMP) FROM loan_txn), "
            "(SELECT CAST(max(date) AS TIMESTAMP) FROM loan_txn), INTERVAL 1 DAY) AS g(d)"
        ),
        "posted_txns": _with(_posted("loan_txn")),
        "active_entities": _with("SELECT DISTINCT loan_id FROM loan_txn" + POSTED_ONLY),
        "entity_date_spine": _with("SELECT * FROM loan_spine", **LOAN_PARTS),
        "last_txn_per_day": _with("SELECT * FROM loan_last", **LOAN_PARTS),
        "forward_fill_balance": _with("SELECT * FROM loan_series", **LOAN_PARTS),
        "running_max_balance": _with(
            _series("loan_spine", "loan_last", "loan_id", "max", ZERO_MONEY), **LOAN_PARTS
        ),
        "ledger_last_known": _with(
            _whole_ledgers("coalesce(last_value(balance IGNORE NULLS) OVER so_far, 0)")
        ),
        "ledger_largest": _with(_whole_ledgers("coalesce(balance, max(balance) OVER so_far, 0)")),
        "dim_calendar": _with(
            "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id, CAST(d AS DATE) AS full_date, "
            "CAST(day(d) AS SMALLINT) AS day, CAST(month(d) AS SMALLINT) AS month, CAST(year(d) AS SMALLINT) AS year "
            "FROM generate_series((SELECT max(date) - INTERVAL 2 YEAR FROM subaccount_txn), "
            "(SELECT max(date) + INTERVAL 2 YEAR FROM subaccount_txn), INTERVAL 1 DAY) AS g(d)"
        ),
        "dim_company": _with(COMPANY),
        "dim_member": _with(MEMBER),
        "dim_account": _with(ACCOUNT),
        "bridge_unfiltered": _with(BRIDGE),
        "bridge_semi_join": dim_bridge,
        "bridge_member_account": dim_bridge,
        "dim_subaccount_loan": _with(SUBACCOUNT_LOAN),
        "dim_subaccount_sub": _with(SUBACCOUNT_SUB),
        "dim_subaccount": _with(SUBACCOUNT),
        "fact_balance_loan": _with(FACT_LOAN, **LOAN_PARTS),
        "fact_balance_sub": _with(FACT_SUB, **DEPOSIT_PARTS),
        "fact_balance_subaccount": _with(FACT, **FACT_PARTS),
        "fact_refreshed": _with(FACT, **FACT_PARTS),
        "fact_ordered": _with(f"SELECT * FROM ({FACT}) ORDER BY subaccount_id, date", **FACT_PARTS),
        "fact_balance_carried": _with(FACT_CARRIED, **CARRIED_PARTS),
        "fact_balance_account": _with(_summary("account_id", "account_days"), **FACT_PARTS, fact=FACT, account_days=ACCOUNT_DAYS),
        "fact_balance_member": _with(
            _summary("member_id", "member_days"),
            **FACT_PARTS,
            **BRIDGE_PARTS,
            fact=FACT,
            known=BRIDGE_KNOWN,
            account_days=ACCOUNT_DAYS,
            member_days=MEMBER_DAYS,
        ),
        "audit_company": _with(AUDIT_COMPANY),
        "audit_member": _with(AUDIT_MEMBER),
        "audit_account": _with(AUDIT_ACCOUNT),
        "audit_bridge": _with(AUDIT_BRIDGE),
        "audit_subaccount": _with(AUDIT_SUBACCOUNT),
        "audit_fact": _with(f"SELECT * FROM ({AUDIT_FACT}) ORDER BY subaccount_id, date", **AUDIT_PARTS),
        "reconcile_fact": _with(
            _reconcile("built", "audited", list(cat.TARGETS["fact_balance_subaccount"].key), ["current_balance"]),
            **FACT_PARTS,
            **AUDIT_PARTS,
            built=FACT,
            audited="SELECT subaccount_id, account_id, client_id, date, CAST(company_id AS VARCHAR) AS company_id, "
            f"CAST(balance AS DECIMAL(18,2)) AS current_balance FROM ({AUDIT_FACT})",
        ),
        "reconcile_dims": _with(
            "\nUNION ALL\n".join(
                _reconcile(f"built_{name}", f"audited_{name}", keys, columns, name)
                for name, (keys, columns) in RECONCILED.items()
            ),
            **RECONCILE_PARTS,
        ),
        "check_primary_key": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL",
        "check_not_null": _with(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS column_name, count(*) AS nulls FROM loan_txn WHERE {c} IS NULL"
                for c in ("loan_id", "date", "balance", "status", "deleted_at")
            )
        ),
        "check_foreign_key": _with(
            "SELECT account_id, count(*) AS rows FROM subaccount AS s WHERE account_id IS NOT NULL "
            "AND NOT EXISTS (SELECT 1 FROM account AS a WHERE a.id = s.account_id) GROUP BY account_id"
        ),
        "check_foreign_key_composite": _with(
            "SELECT member_id, client_id, company_id, count(*) AS rows FROM bridge AS b "
            "WHERE member_id IS NOT NULL AND client_id IS NOT NULL AND company_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM members AS d WHERE d.member_id = b.member_id AND d.client_id = b.client_id "
            "AND d.company_id = b.company_id) GROUP BY member_id, client_id, company_id",
            **BRIDGE_PARTS,
        ),
        "check_unique": _with(
            "SELECT date, count(*) AS rows FROM loan_txn WHERE date IS NOT NULL GROUP BY date HAVING count(*) > 1"
        ),
        "apply_defaults": _with(
            "\nUNION ALL\n".join(
                f"SELECT CAST(seq AS VARCHAR) AS transaction_id, {CLIENT} AS client_id, {NO_TEXT} AS company_id, "
                f"'{ledger.prefix}' || CAST({ledger.txn_holder} AS VARCHAR) AS subaccount_id, {NO_TEXT} AS account_id, "
                f"{_empty('DECIMAL(18,2)', 'amount', 'original_amount')}, 'USD' AS currency, created_at AS timestamp, "
                f"date AS id_date, {NO_TEXT} AS income_expenditure, status, {NO_TEXT} AS type, "
                f"CAST(balance AS DECIMAL(18,2)) AS balance, {NO_TEXT} AS enrichment, {AUDIT} FROM {ledger.txns}"
                + POSTED_ONLY
                for ledger in (cat.LOANS, cat.DEPOSITS)
            )
        ),
        "rejects": _with(
            f"SELECT subaccount_id, account_id, company_id, {missing} AS missing FROM ({SUBACCOUNT}) "
            f"WHERE {' OR '.join(f'{c} IS NULL' for c in required)}"
        ),
        "constraint_audit": _with(audit_body, **audit_parts),
        "upsert_by_key": _with(UPSERT, **_copy_and_changes()),
        "insert_if_absent": _with(INSERT_IF_ABSENT, **_copy_and_changes()),
        "latest_change": _with(
            "SELECT subaccount_id, date, created_at, seq, balance, status, deleted_at FROM (SELECT *, row_number() "
            "OVER (PARTITION BY subaccount_id ORDER BY created_at DESC NULLS LAST, seq DESC NULLS LAST) AS rn "
            "FROM subaccount_txn) WHERE rn = 1"
        ),
        "dictionary_items": _with(_dictionary_items()),
        "dictionary_attrs": _with(_dictionary_attributes()),
        "dictionary_counts": _with(
            "\nUNION ALL\n".join(
                f"SELECT '{t}' AS source_table, count(*) AS items FROM {t}" for t in cat.DICTIONARIES
            )
        ),
    }
