"""Column functions and small table functions shared by the operators."""
