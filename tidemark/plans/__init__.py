"""Batch jobs wired from sources and operators."""
