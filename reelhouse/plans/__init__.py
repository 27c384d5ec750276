"""Plans: table layout and I/O, catalog registration, the full build and
the registry of named queries used by the correctness gate and the bench."""
