"""Sources: message logs, files and tables."""
