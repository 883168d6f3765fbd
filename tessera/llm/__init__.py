"""Training-data operators: deduplication, quality, mixing, packing, search and archive handling.

Each module holds one operator with a general interface; ``queries.py`` registers the thin
``opN_<name>`` queries and their SQL.
"""
