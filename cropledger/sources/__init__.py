"""Catalogue, raw exports, dimension tables, stored tables, report files."""
