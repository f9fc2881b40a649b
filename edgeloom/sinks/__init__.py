"""Writers: archives, idempotent batches, quarantine, ledgers, exports."""
