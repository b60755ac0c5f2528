"""Routing, contract and delivery operators over envelope tables."""
