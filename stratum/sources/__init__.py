"""Scans and sources: driver tables, landing files, bronze ingest, JDBC."""
