"""Columns the builders read from each source table."""

from __future__ import annotations

SOURCE_SCHEMAS: dict[str, str] = {
    "institution": "id bigint, company_id bigint",
    "company": "id bigint, name string",
    "role": "id bigint, type string",
    "sub_role": "id bigint, role_id bigint",
    "member": "id bigint, sub_role_id bigint, institution_id bigint, created_at date, deleted_at date",
    "account": "id bigint, institution_id bigint",
    "ownership_type": "id bigint, key string, type string",
    "member_account": "id bigint, member_id bigint, account_id bigint, ownership_type_id bigint, "
    "is_primary boolean, created_at timestamp_ntz, deleted_at timestamp_ntz",
    "account_type": "id bigint, value string",
    "loan": "id bigint, account_id bigint, account_type_id bigint, current_balance double, "
    "created_at timestamp_ntz, deleted_at timestamp_ntz",
    "subaccount": "id bigint, account_id bigint, account_type_id bigint, amount double, "
    "created_at date, deleted_at date",
    "loan_txn": "loan_id bigint, date date, created_at timestamp_ntz, seq bigint, balance double, "
    "status string, deleted_at timestamp_ntz",
    "subaccount_txn": "subaccount_id bigint, date date, created_at timestamp_ntz, seq bigint, balance double, "
    "status string, deleted_at timestamp_ntz",
}
