"""DataFrame operators: exclusion, alignment, checks, components, split,
metrics and trainers."""
