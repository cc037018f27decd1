"""Contact tables derived from the given test tables, for the registered queries and the tests."""
