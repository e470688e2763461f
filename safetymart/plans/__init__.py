"""Whole runs: bronze to silver, silver to gold."""
