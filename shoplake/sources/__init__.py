"""Readers and message encoders."""
