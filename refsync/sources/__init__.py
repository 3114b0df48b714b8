"""Readers, writers and the versioned table. These are the modules that touch storage."""
