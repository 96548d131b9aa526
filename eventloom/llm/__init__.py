"""Training-data operators: one module each, plus their queries and SQL."""
