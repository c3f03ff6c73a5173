"""Operators over chain tables: each takes DataFrames and returns one."""
