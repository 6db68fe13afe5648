"""Spark-native warehouse, marts, features and evaluation for entities and two-sided matches."""

from matchvault.session import build_session

__all__ = ["build_session"]
