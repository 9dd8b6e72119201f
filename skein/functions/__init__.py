"""Column expressions: keys, alleles, cleaning and rule tables."""
