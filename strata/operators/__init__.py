"""Table-level operators: cleaning rules, silver cleaners, gold aggregates, analyses."""

from strata.operators import analyses, gold, rules, silver

__all__ = ["analyses", "gold", "rules", "silver"]
