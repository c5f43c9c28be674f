"""Operators for preparing training text: de-duplication, classifiers, extraction, mixing, packing, search."""
