"""Warehouse models and tiering plans."""
