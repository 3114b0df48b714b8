"""Column-level helpers: text, dates, numbers and keys. All of them build plain Column expressions."""
