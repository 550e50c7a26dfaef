"""Questions, guards, profiles and the query collection."""
