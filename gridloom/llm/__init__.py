"""Training-data operators: filtering, near-duplicates, search, archives, tokens and mixing.

Nothing outside this package imports it; ``queries`` holds the registered queries.
"""
