"""Column functions: text, dates, matching rules."""
