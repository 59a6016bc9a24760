"""Writers: replace, append, merge and fixed-format text."""
