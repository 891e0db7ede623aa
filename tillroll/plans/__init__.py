"""Composition: the warehouse build and the registered query catalog."""
