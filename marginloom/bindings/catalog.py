"""All registered queries."""

from marginloom.bindings import batch, modelling, pricing, relational, scoring  # noqa: F401
from marginloom.bindings.registry import BUILDERS, ORACLES, callables

__all__ = ["BUILDERS", "ORACLES", "callables"]
