"""Event-record analytics on Spark: operators, sources, scalar functions, plans and streaming."""
