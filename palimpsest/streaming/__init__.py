"""Streaming import."""
