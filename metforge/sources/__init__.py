"""Readers and writers for the tables the flows exchange."""
