"""Query catalogue and the step pipeline."""
