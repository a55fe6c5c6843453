"""Readers that turn landed files into raw bars."""
