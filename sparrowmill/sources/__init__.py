"""Readers and writers: files, JDBC, snapshot datasets, benchmark tables and their entities."""
