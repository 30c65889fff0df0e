"""Whole runs: configuration, prompts, pipelines, the command line, and the registered queries."""
