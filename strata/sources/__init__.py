"""Where rows come from and where they land: test-table adapters, landing
CSVs, Parquet lake folders and catalog tables."""
