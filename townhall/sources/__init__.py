"""Readers and writers for captures, post tables and pages."""
