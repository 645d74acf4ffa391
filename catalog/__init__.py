"""Registered queries, their code-like inputs and their DuckDB counterparts."""
