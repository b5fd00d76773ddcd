"""Checking aids: DuckDB SQL for every registered query."""
