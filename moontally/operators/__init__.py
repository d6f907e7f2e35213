"""DataFrame operators: windows of months, naming, filling, joins and bounded-grain rollups."""
