"""Readers and writers of the formats that scores, genotypes and results come in."""
