"""The engine's operators run over the star-schema test tables, and SQL to check them."""
