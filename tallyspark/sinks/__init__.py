"""Sinks: file writers and checks on what was written."""
