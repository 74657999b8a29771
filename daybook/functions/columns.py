"""Column expressions: every one stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(amount: Column | str) -> Column:
    """Cents-exact amount; text that is no number becomes null instead of failing the job."""
    return _column(amount).try_cast(MONEY)


def prefixed_key(prefix: str, key: Column | str) -> Column:
    """Surrogate key such as ``LOAN42``; a null id gives a null key."""
    return F.concat(F.lit(prefix), _column(key).cast("string"))


def lifecycle_status(ended_at: Column | str) -> Column:
    """A row is ACTIVE until its end timestamp is set."""
    return F.when(_column(ended_at).isNull(), "ACTIVE").otherwise("INACTIVE")


def iso_timestamp(ts: Column | str) -> Column:
    """ISO-8601 text with a microsecond part only where it is not zero."""
    ts = _column(ts)
    whole_second = F.date_format(ts, "SSSSSS") == "000000"
    return F.when(whole_second, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
