"""Relational operators of the module build (graph walk, cohorts, survey,
distributions, lookups, states, dosage, population comparison)."""
