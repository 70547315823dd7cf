"""Registered queries over the provided tables, with an independent SQL statement for each."""
