"""Signal tables and feeds derived from the given star-schema tables, with queries and their SQL."""
