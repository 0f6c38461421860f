"""Reusable operators over DataFrames."""
