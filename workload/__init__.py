"""Registered queries: the library's operators over the test tables, each with its SQL."""
