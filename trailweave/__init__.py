"""Trailweave: a Spark-native analytics engine for web and app event exports."""

from .config import EngineConfig
from .session import configure

__all__ = ["EngineConfig", "configure"]
