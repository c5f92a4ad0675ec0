"""Readers: files to quads, tables, documents, log records and manifests."""
