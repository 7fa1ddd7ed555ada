"""Reconcile visit records between two systems and prepare the missing ones for submission."""
