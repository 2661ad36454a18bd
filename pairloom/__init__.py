"""Record linkage on Spark: clean, link by keys, score, review and resolve two person files."""
