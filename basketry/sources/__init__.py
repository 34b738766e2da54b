"""Reading inputs: raw tables, landing files, seeds, cold storage."""
