"""Table writes, table maintenance and model storage."""
