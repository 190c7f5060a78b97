"""Whole-clip programs: contracts, ledger, pipelines."""
