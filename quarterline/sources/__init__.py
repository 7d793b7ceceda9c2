"""Where rows come from and where snapshots are kept."""
