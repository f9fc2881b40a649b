"""Readers: delivery-log files, bundles, message queues, archives."""
