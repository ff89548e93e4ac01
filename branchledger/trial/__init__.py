"""Registered queries over the test tables, each beside its SQL oracle."""

from branchledger.trial import q_columns, q_dims, q_field, q_files, q_ledger, q_marts  # noqa: F401
from branchledger.trial.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
