"""All registered queries; importing the modules fills the two tables."""

from . import queries_incidents, queries_streaming  # noqa: F401
from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
