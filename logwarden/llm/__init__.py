"""Training-data operators: one module per operator, ``registry`` names their queries."""
