"""Readers: log topics, files and the tables this project writes."""
