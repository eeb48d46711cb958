"""Sources: table loading, file formats, archives, inventories, HTML rows."""
