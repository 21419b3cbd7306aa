"""Operators for language-model data: nearest-time matching, encoding, packing and splitting."""
