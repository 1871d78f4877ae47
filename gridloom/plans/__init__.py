"""Registries, profiles and the catalogue of queries."""
