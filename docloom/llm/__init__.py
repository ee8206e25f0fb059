"""Training-data operators: deduplication, quality, mixing, packing and token files.

Nothing outside this subpackage imports it; its queries are in :mod:`docloom.llm.registry`.
"""
