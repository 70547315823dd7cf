"""Reading, writing and generating tables."""
