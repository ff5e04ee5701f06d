"""Schemas, loaders, writers and stand-in feeds."""
