"""Whole jobs: raw records → canonical adverts → warehouse tables, models and reports."""
