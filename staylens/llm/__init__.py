"""Training-data operators: deduplication, filtering, scoring and packing of documents.

One module per operator, each with a general interface; ``queries.py`` holds the thin
registered queries ``opN_<name>`` and their SQL.  Nothing outside this folder imports it.
"""
