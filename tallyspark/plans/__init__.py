"""Analyses composed from the operators and functions."""
