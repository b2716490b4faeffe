from tieout.catalogue import around, cdc, cut, deliveries, gate, jobs  # noqa: F401
from tieout.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
