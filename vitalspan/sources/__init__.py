"""Reads of files and folders."""
