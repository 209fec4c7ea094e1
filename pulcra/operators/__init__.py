"""Table operators: rules, key resolution, integrity, profile, metrics, audit roll-ups."""
