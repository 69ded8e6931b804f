"""Readers: nested payloads, flat staging files, warehouse tables, test-data adapter."""
