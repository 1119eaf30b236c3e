"""Writing files, grids and update documents."""
