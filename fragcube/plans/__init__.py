"""Whole plans: build, write, read and open a manifest; registered queries."""
