"""Readers and writers for dumps, edge lists, record files and tables."""
