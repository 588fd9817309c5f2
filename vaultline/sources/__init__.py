"""Readers: raw files, snapshot tables, generated spines, test fixtures."""
