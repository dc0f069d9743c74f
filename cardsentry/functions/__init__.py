"""Column functions: no joins, no shuffles, no Python at run time."""
