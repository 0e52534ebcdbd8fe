"""Whole models (staging, marts, KPIs), the daily run, and the driver-table world."""
