"""Every operator as a query over the test tables, with equivalent SQL."""

from jornada.catalogue import edits, joins, landed, listings, loads, rejects, scalars, scans, streams, warehouse  # noqa: F401
from jornada.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
