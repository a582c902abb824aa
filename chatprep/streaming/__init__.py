"""Run metrics as streams."""
