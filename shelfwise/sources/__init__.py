"""Readers and writers (files, JDBC) and the fixture mapping of the driver tables."""
