"""Record-linkage inputs derived from the driver's tables, and their SQL twins."""
