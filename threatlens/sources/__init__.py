"""Readers: streams, files, database tables and the views over the test tables."""
