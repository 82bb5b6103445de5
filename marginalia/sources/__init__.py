"""Readers and stores."""
