"""Scans, sinks, manifests, checksums, ledgers and catalog listings."""
