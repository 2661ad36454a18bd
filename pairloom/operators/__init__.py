"""Relational building blocks shared by the linkage stages."""
