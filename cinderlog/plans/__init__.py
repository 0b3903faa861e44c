"""Whole flows: structuring, reports, training and scoring."""
