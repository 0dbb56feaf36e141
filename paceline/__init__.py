"""Paceline: race-timing, sensor and event-log analytics as Spark DataFrame jobs."""

from paceline.roles import Roles

__all__ = ["Roles"]
__version__ = "0.1.0"
