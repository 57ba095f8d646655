"""Plans: operators put together for a domain, from raw file to findings."""
