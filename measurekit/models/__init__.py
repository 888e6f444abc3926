"""Models fitted by Spark jobs; only parameters (sized by features and classes) reach the driver."""
