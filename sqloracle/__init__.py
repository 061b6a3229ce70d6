"""DuckDB SQL oracles for the correctness gate (independent re-statements of each query)."""
