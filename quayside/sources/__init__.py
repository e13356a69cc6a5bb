"""Where rows come from: scraped pages, stored tables, the provided test tables."""
