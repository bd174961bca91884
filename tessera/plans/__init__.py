"""Stages and their runner."""
