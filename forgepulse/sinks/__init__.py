"""Table loads: rebuild, replace days, upsert, export, retention."""
