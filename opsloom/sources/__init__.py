"""Readers and writers for the file formats the data arrives and leaves in."""
