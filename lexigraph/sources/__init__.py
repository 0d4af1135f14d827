"""Readers that turn stored tables into corpora, query tables and page views."""
