"""Where rows come from: tables (files or JDBC), the catalog, and text files."""
