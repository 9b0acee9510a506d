"""Social-post analytics on Spark: snapshot series, content matching, share of voice and KPI scorecards."""
