"""Reading dated snapshots and writing datasets."""
