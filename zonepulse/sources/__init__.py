"""Reading, writing, retention, and the roles the given tables play."""
