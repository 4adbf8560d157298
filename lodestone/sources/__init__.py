"""Readers (S1-S5) and writers (K1-K4)."""
