"""Runnable jobs: each has a command line and a config file, and its work is a function that takes a session."""
