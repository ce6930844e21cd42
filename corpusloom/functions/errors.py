"""Errors as values: statuses, the permanent mark and its code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERMANENT = "PERMANENT_ERROR:"


def permanent(code: Column | str, text: Column | str) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    return F.concat(F.lit(PERMANENT), lit(code), F.lit(":"), lit(text))


def status_error(status: Column, reason: Column, url: Column, permanent_statuses: tuple[int, ...] = (403, 404, 410)) -> Column:
    """NULL for a success, a permanent error for the given statuses, else a temporary one. A NULL status is a failed request."""
    plain = F.concat(F.lit("HTTP "), status.cast("string"), F.lit(": "), F.coalesce(reason, F.lit("")))
    return (
        F.when(status.isNull(), F.coalesce(reason, F.lit("Unknown error")))
        .when(status.between(200, 299), F.lit(None).cast("string"))
        .when(status.isin(*permanent_statuses), permanent(status, url))
        .otherwise(plain)
    )


def is_permanent(error: Column) -> Column:
    return F.coalesce(error.contains(PERMANENT), F.lit(False))


def permanent_code(error: Column) -> Column:
    """The numeric code of a permanent error, else ``unknown``."""
    code = F.regexp_extract(error, PERMANENT + r"(\d+):", 1)
    return F.when(code == "", "unknown").otherwise(F.coalesce(code, F.lit("unknown")))


def row_status(error: Column, changed: Column) -> Column:
    """``permanent_error``, ``temporary_error``, ``changed`` or ``unchanged``; an error wins."""
    return (
        F.when(error.isNotNull() & is_permanent(error), "permanent_error")
        .when(error.isNotNull(), "temporary_error")
        .when(changed, "changed")
        .otherwise("unchanged")
    )
