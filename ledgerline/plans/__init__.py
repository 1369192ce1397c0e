"""Whole-job plans: fact materialisation, the full report, plan inspection."""
