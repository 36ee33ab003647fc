"""Small classifiers: prediction, evaluation and data-parallel training."""
