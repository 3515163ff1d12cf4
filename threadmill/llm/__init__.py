"""Training-data operators: near-dedup, mixing, search, language, secrets,
substring and line dedup, toxicity, BPE and quality rules.

Nothing else in the package imports this folder; ``queries.py`` holds the
registered queries and their SQL.
"""
