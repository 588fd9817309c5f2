"""Column expressions shared by the operators (all JVM-side built-ins)."""

from vaultline.functions.exprs import (
    classify,
    flag,
    lookup_expr,
    parse_timestamp,
    unix_seconds,
    weighted_sum,
)

__all__ = ["classify", "flag", "lookup_expr", "parse_timestamp", "unix_seconds", "weighted_sum"]
