"""Readers and writers: relational tables, JSON documents and payloads, the warehouse, CSV exports."""
