"""Training-data operators: tokenising, scanning, deduplicating, extracting and packing text.

Nothing else in the library imports this subpackage.
"""
