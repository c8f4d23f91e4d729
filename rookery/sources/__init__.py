"""Readers and writers: archive objects, landed responses, leaderboards, tables."""
