"""Column functions: arrays, numbers, labels and text."""
