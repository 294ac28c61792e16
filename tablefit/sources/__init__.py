"""Season paths, per-file-header CSV scans, table sinks and scans."""
