"""Reading and cleaning of input records, and writing of results."""
