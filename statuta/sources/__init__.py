"""Readers and writers of article files and question logs."""
