"""Named queries and the SQL that states each of their results independently."""
