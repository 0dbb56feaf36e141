"""Imports every query module, so that the registry is complete."""

from paceline.plans import q_control, q_documents, q_domain, q_laps, q_ml, q_prep, q_signal, q_sources, q_stats, q_strategy, q_text  # noqa: F401
from paceline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
