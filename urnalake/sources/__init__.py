"""Readers and writers."""

from urnalake.sources import archives, audit_log, files, landed_csv, manifest, tables

__all__ = ["archives", "audit_log", "files", "landed_csv", "manifest", "tables"]
