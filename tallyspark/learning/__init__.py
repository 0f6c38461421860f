"""Regression and classification experiments on Spark ML."""
