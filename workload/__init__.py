"""Registered queries over the driver's tables, each next to its SQL counterpart."""

from workload import loops, odd, quality, reports, results, stored, streams  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
