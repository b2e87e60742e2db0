"""Column expressions and the few scalar Arrow UDFs."""
