"""The library over the given star-schema tables: inputs, queries and SQL twins."""
