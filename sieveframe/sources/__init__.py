"""Reading raw files and tables, writing snapshots, tables and exports."""
