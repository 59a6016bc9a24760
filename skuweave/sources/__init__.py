"""Readers: tables, delimited files, landed pages and object listings."""
