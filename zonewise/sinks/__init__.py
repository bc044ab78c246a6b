"""Writers: keyed JSON messages, CSV, model metadata, snapshots per batch, tables with expiry."""
