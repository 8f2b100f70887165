"""Row-by-row clean-up of annotation files as they arrive."""
