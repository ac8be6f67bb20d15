"""Operators for training text: repetition, groups, near-duplicates, scan noise, encodings, packing, leaks, spam."""
