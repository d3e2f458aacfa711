"""matchmill: layered analytics on two-sided fixtures, packed events and cumulative snapshots, as Spark DataFrame jobs."""
