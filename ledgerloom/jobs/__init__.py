"""Scheduled jobs from files to committed runs."""
