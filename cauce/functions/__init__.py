"""Column functions of the business rules. All of them are built-in expressions."""
