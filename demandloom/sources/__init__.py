"""Readers for the raw CSV files, the layer tables and the learner files."""
