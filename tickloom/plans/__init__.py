"""Registered queries; importing this package registers all of them."""

from tickloom.plans import auditing, covering, decoding, repairing, storing, streams, trading, universe, whole  # noqa: F401
from tickloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
