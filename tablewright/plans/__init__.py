"""Configuration → pipeline documents, and the step runner."""
