"""Query plans over the clean tables, and the lake that holds them."""
