"""Writers: curated layer, snapshots and warehouse tables."""
