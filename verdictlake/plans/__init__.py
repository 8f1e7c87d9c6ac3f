"""Bindings of the test tables and the query registry."""
