"""Cost allocation for shared AI services, as DataFrame-to-DataFrame operators."""
