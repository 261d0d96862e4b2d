"""Readers: delimited text, ZIP archives, file listings, JDBC tables."""
