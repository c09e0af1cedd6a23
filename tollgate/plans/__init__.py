"""Plan helpers: size-checked joins, the end-to-end chains and the testbed."""
