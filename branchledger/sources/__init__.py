"""Readers for report drops, folders of files and catalog tables."""
