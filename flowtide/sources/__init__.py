"""Readers, saved tables, views and checkpoints."""
