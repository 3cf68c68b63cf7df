"""Training-data operators: deduplication, filtering, decontamination, personal
data, archives, similarity search, mixing and chat formatting.

Nothing outside this package imports it.
"""
