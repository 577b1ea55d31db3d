"""Column functions over text, and the fixed values they use."""
