"""Runnable jobs: each is a function of a session, paths and settings, with a command line and a small config file."""
