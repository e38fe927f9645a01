"""Operators for preparing training text: filtering, deduplication, mixing, sharding, tokenised output."""
