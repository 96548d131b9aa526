"""DataFrame operators: joins, merges, aggregates, state."""
