"""File-arrival streams over the batch operators."""
