"""Relational building blocks: DataFrames in, DataFrame out. Only ``storage`` writes."""
