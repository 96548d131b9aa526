"""Query catalogue, extraction steps and the workflow."""
