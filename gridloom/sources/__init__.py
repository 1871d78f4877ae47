"""Readers and writers of snapshots, stores, ledgers and polygons."""
