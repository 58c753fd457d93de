"""Jobs: operators composed with storage."""
