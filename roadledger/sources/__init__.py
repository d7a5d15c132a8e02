"""Readers and writers: collision files, weather payloads, warehouse tables and reports."""
