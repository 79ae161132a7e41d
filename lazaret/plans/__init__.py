"""Rule presets, the repair loop and whole jobs."""
