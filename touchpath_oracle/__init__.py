"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from touchpath_oracle.sql import oracle_sql

__all__ = ["oracle_sql"]
