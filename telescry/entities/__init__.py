"""Metadata entities: table specs and the builders that stage their rows."""
