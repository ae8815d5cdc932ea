"""Writers: topics, keyed and append report tables, dead letters, retention."""
