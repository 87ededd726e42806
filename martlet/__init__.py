"""martlet: raw JSON purchase events to an analysis-ready mart, on Spark DataFrames."""
