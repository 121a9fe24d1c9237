"""Where rows come from: stores, the entity registry and its column allow-lists."""
