"""Physical-plan helpers: written intermediates, distributed numbering, skew-safe joins."""
