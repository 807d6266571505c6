"""Registered queries and the SQL that checks them."""

from tidemark.suite import (  # noqa: F401
    courtesy,
    dialogue,
    extras,
    helpers,
    landing,
    models,
    quality,
    reports,
    sales,
    streams,
)
from tidemark.suite.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
