"""Registered queries.  Importing this package registers every plan."""

from tandem.plans.registry import ORACLES, QUERIES, query  # noqa: F401
from tandem.plans import batches, clean, decode, evaluate, profile, sources, text  # noqa: F401,E402
from tandem.plans import streaming  # noqa: F401,E402

__all__ = ["ORACLES", "QUERIES", "query"]
