"""Operators that prepare a text corpus for training: one module each, all on DataFrames."""
