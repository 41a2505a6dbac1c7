"""Ready-made runs: the nightly report set and the queries over the test tables."""
