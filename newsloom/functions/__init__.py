"""Column functions: built from SQL expressions unless their docstring says otherwise."""
