"""Operators on DataFrames: chunking, merging, matching and scoring, reports, task batches."""
