"""Registered queries, grouped by subject."""

from ticketloom.catalogue import text_queries  # noqa: F401
from ticketloom.catalogue import incident_queries  # noqa: F401
from ticketloom.catalogue import model_queries  # noqa: F401
from ticketloom.catalogue import vector_queries  # noqa: F401
from ticketloom.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
