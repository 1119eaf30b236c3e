"""Reading folders and grid documents."""
