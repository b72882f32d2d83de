"""Where rows come from and go to: CSV files and layered Parquet tables."""
