"""Operators for preparing training corpora and vector tables at scale."""
