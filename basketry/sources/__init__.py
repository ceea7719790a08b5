"""Readers and writers of the tables the jobs exchange."""
