"""The record stream into the raw table."""
