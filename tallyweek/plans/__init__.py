"""The reports: DataFrames in, one lazy DataFrame out, all seasons in one plan."""
