"""Plan building blocks: blocked running values and range joins."""
