"""Reading tables and files, and the stand-in passenger relation."""
