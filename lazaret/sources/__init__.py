"""Readers, topics, tables and writers."""
