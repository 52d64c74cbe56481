"""Operators for preparing training text: mixing, rules, joins, archives, models."""
