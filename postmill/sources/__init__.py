"""Landed data in, published data out."""
