"""Stages: each one reads tables, composes operators and writes tables."""
