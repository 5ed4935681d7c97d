"""Readers of base tables and the entity tables derived from them."""
