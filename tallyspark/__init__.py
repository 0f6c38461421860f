"""Spark-first analytics: grouped statistics, season tables, energy costs,
word and color counts, keyed-table changes, streaming totals, experiments.

Every function takes DataFrames and column names and returns a lazy DataFrame
(or a Column); Catalyst picks the physical plan.
"""
