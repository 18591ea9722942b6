"""Readers and writers of panels and the tables that travel with them."""

from . import plink, sinks, text

__all__ = ["plink", "sinks", "text"]
