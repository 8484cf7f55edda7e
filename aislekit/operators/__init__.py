"""DataFrame -> DataFrame operators, one module per inventory family."""
