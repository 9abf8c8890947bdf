"""Reading inputs from the catalog or a database, and the stored control table."""
