"""Transformations from source records to tables and reports."""
