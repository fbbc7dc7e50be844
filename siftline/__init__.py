"""Message screening and moderation analytics on Apache Spark."""
