"""Jobs composed of the operators, and the queries over the test tables."""
