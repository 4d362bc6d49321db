"""Bounded file streams over the same shaping code as batch."""
