"""Physical-plan helpers: checkpoints, ordered scans, size-checked broadcasts."""
