"""Operators over article frames: union, dedupe, labels, vectors, splits, metrics."""
