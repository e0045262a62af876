"""DataFrame operators, by layer: bronze, pages, silver, quality, corpus, marts, analytics."""
