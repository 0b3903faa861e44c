"""Relational building blocks: parsing, mining, sessions, ranking, features, series."""
