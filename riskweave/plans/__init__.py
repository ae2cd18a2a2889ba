"""Every operator applied to the supplied tables."""

from riskweave.plans import rows, groups, windows, network, measures, learning, forests, marts, streams, layered  # noqa: F401
from riskweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
