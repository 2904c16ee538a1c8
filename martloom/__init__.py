"""Build, check, upsert and publish denormalised data marts on Spark."""
