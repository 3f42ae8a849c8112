"""Generations, manifests and publication."""
