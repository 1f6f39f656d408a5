"""Importing this module registers every query."""

from chatloom.plans import (  # noqa: F401
    q_balance, q_contracts, q_labels, q_preference, q_prepare, q_serving, q_sources, q_streams, q_synthesis, q_texts, q_vectors,
)
from chatloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
