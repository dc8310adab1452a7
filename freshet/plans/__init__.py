"""Industry plans: each one is a transform made of operators, with its schema."""
