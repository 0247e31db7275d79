"""The models wired together."""
