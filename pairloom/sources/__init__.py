"""Readers, writers and the layout of stage datasets."""
