"""Inventory and sales analytics on a layered lakehouse, written for Spark."""
