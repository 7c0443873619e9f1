"""The operators on the star-schema test tables, each with an equivalent SQL statement."""
