"""Training-data operators: sharding, quality, dedup, joins, scoring, output.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` holds the registered
queries and their DuckDB SQL.
"""
