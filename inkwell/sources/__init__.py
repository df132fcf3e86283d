"""Readers and writers: manifests and bundles in, stage rows, snapshots and reports out."""
