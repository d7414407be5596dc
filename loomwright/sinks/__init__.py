"""Writing tables: replacing, merging, evolving, and files of bounded size."""
