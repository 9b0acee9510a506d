"""The models: DataFrames in, one DataFrame out."""
