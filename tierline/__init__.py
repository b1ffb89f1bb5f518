"""tierline: raw text tables to typed, flagged, business-level tables on Spark."""
