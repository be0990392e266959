"""Readers and writers: CSV, topics, versioned tables, generated tickets."""
