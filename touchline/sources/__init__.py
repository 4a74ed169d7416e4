"""Table, file and model storage."""
