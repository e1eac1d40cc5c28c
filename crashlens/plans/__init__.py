"""Analyses, their variants, operator queries, oracles, report job and registry."""
