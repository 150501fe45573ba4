"""Corpus operators for training data, and the queries that apply them."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
