"""Rental snapshot analytics as Spark plans."""
