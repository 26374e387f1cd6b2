"""corpusforge: training-table preparation and completion scoring on Spark."""
