"""Target tables: columns, keys and references, and the projection that fits a frame to them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT, INT, SMALL, DAY, FLAG = T.StringType(), T.IntegerType(), T.ShortType(), T.DateType(), T.BooleanType()
MONEY, MOMENT = T.DecimalType(18, 2), T.TimestampNTZType()


@dataclass(frozen=True)
class Reference:
    """Foreign key: ``columns`` name a row of ``parent`` by its key columns, in that order."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Target:
    name: str
    columns: dict[str, T.DataType]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    unique: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.columns.items()])

    @property
    def not_null(self) -> tuple[str, ...]:
        """Required columns and the key's."""
        return tuple(c for c in self.columns if c in self.key or c in self.required)


AUDIT = {"first_uploaded": MOMENT, "last_uploaded": MOMENT}


def _to(parent: str, *columns: str) -> Reference:
    return Reference(columns, parent, columns)


TO_CLIENT = _to("dim_client", "client_id")
TO_COMPANY = _to("dim_company", "company_id", "client_id")
TO_MEMBER = _to("dim_member", "member_id", "client_id", "company_id")
TO_ACCOUNT = _to("dim_account", "account_id", "company_id", "client_id")

# In load order: a table comes after those it refers to.
TARGETS: dict[str, Target] = {
    t.name: t
    for t in (
        Target(
            "dim_client",
            {"client_id": INT, "name": TEXT, "period": TEXT, "config": TEXT, **AUDIT},
            key=("client_id",),
        ),
        Target(
            "dim_calendar",
            {"id": INT, "full_date": DAY, "day": SMALL, "month": SMALL, "year": SMALL},
            key=("id",),
            required=("full_date", "day", "month", "year"),
            unique=("full_date",),
        ),
        Target(
            "dim_company",
            {"company_id": TEXT, "client_id": INT, "name": TEXT, "config": TEXT, "parent_company_id": TEXT, **AUDIT},
            key=("company_id", "client_id"),
            references=(TO_CLIENT,),
        ),
        Target(
            "dim_member",
            {
                "member_id": TEXT, "client_id": INT, "company_id": TEXT, "status": TEXT,
                "created_at": MOMENT, "deleted_at": MOMENT, **AUDIT,
            },
            key=("member_id", "client_id", "company_id"),
            references=(TO_CLIENT, TO_COMPANY),
        ),
        Target(
            "dim_account",
            {"account_id": TEXT, "company_id": TEXT, "client_id": INT, "internal_external": TEXT, **AUDIT},
            key=("account_id", "company_id", "client_id"),
            references=(TO_CLIENT,),
        ),
        Target(
            "dim_subaccount",
            {
                "subaccount_id": TEXT, "account_id": TEXT, "client_id": INT, "company_id": TEXT, "company_name": TEXT,
                "internal_or_external": TEXT, "default_type": TEXT, "custom_type": TEXT,
                "default_asset_liability": TEXT, "custom_asset_liability": TEXT, "status": TEXT,
                "current_balance": MONEY, "available_balance": MONEY,
                "created_at": MOMENT, "deleted_at": MOMENT, **AUDIT,
            },
            key=("subaccount_id", "account_id", "client_id", "company_id"),
            references=(TO_CLIENT, TO_COMPANY, TO_ACCOUNT),
        ),
        Target(
            "bridge_member_account",
            {
                "member_account_id": TEXT, "client_id": INT, "company_id": TEXT, "member_id": TEXT, "account_id": TEXT,
                "ownership_type": TEXT, "is_primary": FLAG, "status": TEXT,
                "created_at": MOMENT, "deleted_at": MOMENT, **AUDIT,
            },
            key=("member_account_id", "client_id"),
            required=("company_id", "member_id", "account_id"),
            references=(TO_CLIENT, TO_COMPANY, TO_MEMBER, TO_ACCOUNT),
        ),
        Target(
            "fact_balance_subaccount",
            {
                "subaccount_id": TEXT, "account_id": TEXT, "client_id": INT, "company_id": TEXT, "date": DAY,
                "current_balance": MONEY, "available_balance": MONEY, **AUDIT,
            },
            key=("subaccount_id", "account_id", "client_id", "company_id", "date"),
            references=(TO_CLIENT, TO_COMPANY),
        ),
        # Declared for its readers; no source fills it.
        Target(
            "fact_transactions",
            {
                "transaction_id": TEXT, "client_id": INT, "company_id": TEXT, "subaccount_id": TEXT, "account_id": TEXT,
                "amount": MONEY, "currency": TEXT, "original_amount": MONEY, "timestamp": MOMENT, "id_date": DAY,
                "income_expenditure": TEXT, "status": TEXT, "type": TEXT, "balance": MONEY, "enrichment": TEXT, **AUDIT,
            },
            key=("transaction_id", "client_id"),
            required=("company_id",),
            references=(TO_CLIENT, TO_COMPANY),
            defaults={"currency": "USD"},
        ),
    )
}

# Sums over other tables' rows. A sum of amounts may need more digits than an amount.
SUM = T.DecimalType(28, 2)
SUMMARIES: dict[str, Target] = {
    t.name: t
    for t in (
        Target(
            "fact_balance_account",
            {"account_id": TEXT, "client_id": INT, "company_id": TEXT, "date": DAY, "current_balance": SUM, **AUDIT},
            key=("account_id", "client_id", "company_id", "date"),
            references=(TO_CLIENT, TO_COMPANY, TO_ACCOUNT),
        ),
        Target(
            "fact_balance_member",
            {"member_id": TEXT, "client_id": INT, "company_id": TEXT, "date": DAY, "current_balance": SUM, **AUDIT},
            key=("member_id", "client_id", "company_id", "date"),
            references=(TO_CLIENT, TO_COMPANY, TO_MEMBER),
        ),
    )
}


def conform(df: DataFrame, target: Target, run_ts: datetime | None = None) -> DataFrame:
    """Fit a frame to a target's columns, in order and type.

    A column the frame lacks becomes the target's default, or null; a null in a column the frame
    has stays null. ``run_ts`` stamps the rows as first uploaded then. A column the target does not
    know is an error.
    """
    present = set(df.columns)
    unknown = present - set(target.columns)
    if unknown:
        raise ValueError(f"{target.name} has no column {', '.join(sorted(unknown))}")
    supplied = dict(target.defaults)
    if run_ts is not None:
        supplied["first_uploaded"] = run_ts

    def text(name: str) -> str:
        if name in present:
            return f"`{name}`"
        value = supplied.get(name)
        return "NULL" if value is None else f"'{value}'"

    return df.selectExpr(
        *(f"CAST({text(name)} AS {kind.simpleString()}) AS `{name}`" for name, kind in target.columns.items())
    )
