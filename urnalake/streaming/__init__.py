"""Incremental loads."""

from urnalake.streaming.bronze import load_new_files

__all__ = ["load_new_files"]
