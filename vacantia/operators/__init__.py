"""Table-to-table operators: de-duplication, keys, medians, keyed merges, top-k, profiles."""
