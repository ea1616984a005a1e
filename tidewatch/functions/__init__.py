"""Column expressions: text, time, links, SQL types, sentiment."""
