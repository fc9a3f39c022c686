"""Operators for large text corpora: de-duplication, scoring, filtering, mixing and token output."""
