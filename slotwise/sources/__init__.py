"""Readers for raw tables, property bags and text orders; writers for results."""
