"""Composite jobs and the registered driver-table queries."""
