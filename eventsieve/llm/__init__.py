"""Training-data operators: quality rules, license scans, near duplicates, secrets, mixing,
tokens, vector search, page text, languages and chat formatting.

Nothing outside this folder imports it; the registered queries are in ``queries`` and their
SQL is in ``oracle``.
"""
