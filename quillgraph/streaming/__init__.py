"""Incremental reading of exports."""
