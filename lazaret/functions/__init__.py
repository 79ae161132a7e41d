"""Column builders: rules, number cleaning, JSON codec, identity."""
