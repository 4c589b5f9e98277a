"""Relational operators: functions from DataFrame to DataFrame."""
