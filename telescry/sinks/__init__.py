"""Writers: partitioned appends, demultiplexing, retention, key-value tables."""
