"""Operators on whole tables, ``DataFrame -> DataFrame``."""
