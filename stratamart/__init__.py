"""Layered trip analytics on Spark: files in, query-ready star schema out.

Every operator takes and returns DataFrames; Catalyst plans them. See README.md.
"""
