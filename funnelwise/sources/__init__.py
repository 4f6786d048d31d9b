"""Landed files in, published tables out."""
