"""Composed jobs, and the registered queries with their reference SQL."""
