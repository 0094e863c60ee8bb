"""Column expressions: text normalisation, audit rules, fixed values."""
