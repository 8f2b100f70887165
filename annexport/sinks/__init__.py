"""Where results go: CSV, lines and JSON folders, written partition by partition."""
