"""Operators for preparing training data: token files, mixing, near duplicates, archives, text extraction, scores, search."""
