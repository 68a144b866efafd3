"""Training-data operators: mixing, near-duplicates, decontamination, language, tokens, shards, lines, PII, chat.

Nothing else in the library imports this subpackage.
"""
