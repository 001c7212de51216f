"""Building blocks for ordered work over groups of any size."""
