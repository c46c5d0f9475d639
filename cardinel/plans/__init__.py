"""Notification texts, dashboard queries and the whole monitoring job."""
