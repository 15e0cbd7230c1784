"""Readers of date-sharded event exports, and the adapter that derives one from the test tables."""
