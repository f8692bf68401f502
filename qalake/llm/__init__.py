"""Training-data operators: tokenisation, search, deduplication, filtering, mixing.

Nothing outside this subpackage imports it. Each operator module holds one
operator with a general interface; ``queries.py`` derives the registered
``opN_*`` queries from them.
"""
