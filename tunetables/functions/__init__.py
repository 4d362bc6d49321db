"""Column functions: text, token arrays, image references, JSON documents."""
