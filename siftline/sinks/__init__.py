"""Writers: moderation feed, lake tables and analytics table."""
