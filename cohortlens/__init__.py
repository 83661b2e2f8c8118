"""Profile, clean, segment and describe wide record tables on Spark."""
