"""Relational operators: projection, star and fan-out joins, quality rules, upsert."""
