"""Landing files, stored tables, loads and exports."""
