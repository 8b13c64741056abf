"""Request, result, log and catalogue views of the test tables, and the registered queries."""
