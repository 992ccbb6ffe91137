"""Readers: places lists and landed daily responses."""
