"""The domain operators. Every function takes and returns DataFrames and is lazy."""
