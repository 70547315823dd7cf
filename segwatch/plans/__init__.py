"""Stored run history and the end-to-end jobs composed from the operators."""
