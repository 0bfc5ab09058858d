"""Lot-ledger: property-record analytics written as PySpark DataFrame functions."""
