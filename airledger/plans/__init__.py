"""Named queries over a data directory, their SQL twins for checking, and the SQL views."""
