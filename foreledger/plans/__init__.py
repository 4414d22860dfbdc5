"""The layers, from staged versions to the daily report."""
