"""Column expressions: no data access, no Python UDFs."""
