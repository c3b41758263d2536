"""Training-data operators: dedup, secret scans, tokens, classifiers, joins,
sharding, nearest neighbours, packing.  Nothing else in the library imports
this subpackage."""
