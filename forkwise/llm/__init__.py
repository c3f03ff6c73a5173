"""Training-data operators: quality, deduplication, privacy, packing, search and archives.

Nothing outside this subpackage imports it. Every module holds one operator with its own
general interface; ``queries`` wires them to the driver's tables.
"""
