"""Composed plans: the driver-table mapping, the layered run, the query registry."""
