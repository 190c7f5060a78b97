"""Readers and writers; each reader pairs a scan with a DataFrame decoder."""
