"""Order refinery: messy order records in, an analytics-ready star schema out."""
