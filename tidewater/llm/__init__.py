"""Training-data operators: scoring, filtering, deduplication, packing, formatting, token counts.

Each operator is a module with a general interface; ``queries`` registers one thin
query per operator over the documents, pages, benchmark and conversations tables.
Nothing else in the library imports this package.
"""
