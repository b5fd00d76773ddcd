"""DataFrame -> DataFrame operators: decoding, cleaning, pre-aggregated joins,
top-1 per group and exact weighted medians."""
