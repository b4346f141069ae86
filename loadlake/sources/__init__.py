"""Readers and writers: landed JSON documents, lake tables, result tables, event logs."""
