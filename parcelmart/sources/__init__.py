"""Operational source tables, the warehouse tables and the test-data mapping."""
