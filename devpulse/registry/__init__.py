"""Every operator as a query over the given tables, next to plain SQL that must agree with it."""

from devpulse.registry import (  # noqa: F401
    declared,
    ingest,
    joins,
    marts,
    quality,
    reports,
    shaping,
)
from devpulse.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
