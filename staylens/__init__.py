"""staylens: rental-market analytics as DataFrame -> DataFrame operators on Spark."""
