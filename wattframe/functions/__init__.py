"""Column-only building blocks. Everything here is a Catalyst expression; no Python workers."""
