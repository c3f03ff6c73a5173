"""Reorg-safe chain-state analytics on Spark."""
