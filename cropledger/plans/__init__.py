"""Indicators: one function per report table, from model inputs to report rows."""
