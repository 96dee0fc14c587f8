"""Readers that turn files into long tables."""
