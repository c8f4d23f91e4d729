"""Operators: ``DataFrame -> DataFrame``, lazy, without actions."""
