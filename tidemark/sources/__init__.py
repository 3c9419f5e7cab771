"""Readers and writers: feed, topic, raw zone, control table, snapshot table."""
