"""Registered queries over the input tables and their SQL oracles."""
