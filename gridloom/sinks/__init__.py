"""Writers for checkpoints, published versions and training logs."""
