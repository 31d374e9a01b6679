"""Writers for lake tables, catalog registration and file copies."""
