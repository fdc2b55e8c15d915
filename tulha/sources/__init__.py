"""Scans: delimited files, station files, archives, responses, pages, tables."""
