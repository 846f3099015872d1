"""Registered queries over the driver tables, each with its DuckDB SQL twin."""

from prepframe.plans.registry import ORACLE, QUERIES, load  # noqa: F401
from prepframe.plans import prep, metrics, reshape, models, streams, io, checks  # noqa: F401,E402
