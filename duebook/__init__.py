"""duebook: instalment-receivables reporting as lazy Spark plans."""

from duebook.context import Context, Rules

__all__ = ["Context", "Rules"]
