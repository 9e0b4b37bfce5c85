"""Ready-made reports and the queries built on the test tables."""
