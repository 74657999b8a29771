"""Column expressions shared by the builders."""

from daybook.functions.columns import (
    iso_timestamp,
    lifecycle_status,
    money,
    prefixed_key,
)

__all__ = ["iso_timestamp", "lifecycle_status", "money", "prefixed_key"]
