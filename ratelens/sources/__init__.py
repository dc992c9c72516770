"""Inputs: text-file readers (files) and the entities of the driver tables (tables)."""
