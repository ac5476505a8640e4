"""Where files and pages come from."""
