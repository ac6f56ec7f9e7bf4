"""Column helpers shared by the operators. All are built-in Spark expressions."""
