"""DataFrame -> DataFrame operators: cleaning, gaps, slots, merges, dimensions, quality, joins."""
