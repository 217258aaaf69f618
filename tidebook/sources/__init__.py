"""Extracts, declared schemas, files, and the bindings of concrete tables."""
