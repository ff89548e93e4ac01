"""Column expressions: text clean-up, parsing, conditional rules. No Python UDFs."""
