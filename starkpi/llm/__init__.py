"""Training-data operators: one module per operator, each with its own general
interface, plus ``queries`` (the registered queries and their DuckDB SQL)."""
