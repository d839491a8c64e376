"""Readers and writers of date-partitioned tables and of nested API pages."""
