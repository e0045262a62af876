"""Readers and writers: JSON batches, snapshots, CSV."""
