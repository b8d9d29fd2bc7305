"""Readers and writers: raw envelopes, bronze appends, layer tables, configs, alert log, CSV export."""
