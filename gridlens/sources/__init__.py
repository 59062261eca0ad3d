"""Readers (S1-S5) and writers (K1-K8) of the date-partitioned tables."""
