"""The models: staging, sessions, first visits, the report marts and the quality checks."""
