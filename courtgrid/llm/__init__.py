"""Training-data operators: near-duplicate joins, line removal, scoring,
sharding, mixing and packing of text corpora.  Nothing else in the library
imports this subpackage."""
