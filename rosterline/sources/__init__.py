"""Readers and writers: files, versioned directories and JDBC tables."""
