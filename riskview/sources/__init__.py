"""Typed landing readers, landing inventory and the layered table store."""
