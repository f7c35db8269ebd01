"""Composed plans (customer 360, pipeline runs) and the query catalog."""
