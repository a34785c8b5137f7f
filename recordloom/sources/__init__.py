"""Readers, writers, the record store, generators and adapters."""
