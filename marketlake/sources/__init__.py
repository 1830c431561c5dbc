"""Lake files: readers, partitioned writes, compaction."""
