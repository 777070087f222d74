"""Operators composed into whole analyses and into the registered queries."""
