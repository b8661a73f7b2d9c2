"""Operators for preparing training data. Nothing else in the package imports this folder."""

from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
