"""Operators for training data: filters, classifiers, dedup, extraction, tokens and fingerprints."""
