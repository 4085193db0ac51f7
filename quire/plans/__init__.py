"""Named queries (catalog), their SQL twins (oracle), tidy reports, batch jobs, lineage cuts."""
