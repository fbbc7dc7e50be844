"""The continuous screening job."""
