"""Writers: tables, partitions, files, databases."""
