"""Column-level helpers shared by every operator; built-in expressions only."""
