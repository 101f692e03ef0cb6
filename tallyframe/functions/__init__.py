"""Column expressions: text cleaning, parsing, sale predicates, token arrays."""
