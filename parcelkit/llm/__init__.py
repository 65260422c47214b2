"""Training-data operators: near-duplicate search, exact search, substring
dedup, tokenisation, packing, language-model scoring, archives, toxicity.

Nothing else in the library imports this subpackage.
"""
