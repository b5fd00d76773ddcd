"""Readers: CSV, JSON topic directories, JDBC tables, key lookup, and the
raw record tables derived from the TPC-H-style test data."""

from postlake.sources.files import lookup_value, read_csv, read_topic, single_value
from postlake.sources.jdbc import read_jdbc

__all__ = ["lookup_value", "read_csv", "read_topic", "single_value", "read_jdbc"]
