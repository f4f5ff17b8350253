"""Training-data operators: archive, clean, deduplicate, score and pack text tables.

Nothing outside this subpackage imports it.
"""
