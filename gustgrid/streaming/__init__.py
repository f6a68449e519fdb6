"""Incremental processing of hourly trees."""
