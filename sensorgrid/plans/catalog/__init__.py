"""Registered queries: operators bound to the driver's tables, each with its SQL oracle."""

from sensorgrid.plans.catalog import graphs, imputation, messages, readings, streams, training  # noqa: F401
from sensorgrid.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
