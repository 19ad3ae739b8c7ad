"""Readers and writers: input tables, CSV, file inventory, playlist snapshots."""
