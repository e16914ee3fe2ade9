"""Scans: GA4 export, source categories, warehouse tables, weekly media CSV."""
