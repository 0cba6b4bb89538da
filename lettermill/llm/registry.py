"""Modules of this subpackage that hold QUERIES and SQL."""

MODULES = ["lettermill.llm.queries"]
