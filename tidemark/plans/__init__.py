"""Named queries over the operators, and SQL that they are held against."""
