"""Queries of the check harness: test tables bound to the nine domain tables, and their SQL."""
