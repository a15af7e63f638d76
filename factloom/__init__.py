"""Evidence-graph analytics on Spark: documents and tables in, a traceable fact graph and ranked retrieval out."""
