"""Readers, writers and the adapter that derives the input relations from the driver tables."""
