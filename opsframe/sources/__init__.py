"""Readers: metric files, object listings, manifests and numbered lines."""
