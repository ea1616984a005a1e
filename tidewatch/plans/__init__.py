"""Composed steps a user calls: bronze, silver, gold, decisions, digest, full run."""
