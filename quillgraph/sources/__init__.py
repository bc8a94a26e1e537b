"""Readers of dictionary exports and package tables."""
