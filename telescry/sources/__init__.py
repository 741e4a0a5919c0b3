"""Readers: streams, files, landed API payloads, metadata snapshots."""
