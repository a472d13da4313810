"""Operators over images, chunks, chunk texts and files: DataFrames in, DataFrames out."""
