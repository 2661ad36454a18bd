"""Column functions: names, missing codes, geography, addresses, similarity and set measures."""
