"""Whole dataflows: landing data, the layered rental pipeline, the sales star."""
