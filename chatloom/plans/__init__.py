"""Plan helpers shared by the operators, test views and the query registry."""
