"""riskview: customer due-diligence analytics on Spark DataFrames."""
