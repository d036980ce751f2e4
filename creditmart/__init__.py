"""creditmart: Spark jobs for a monthly credit-risk data mart and its scoring loop."""

__version__ = "0.1.0"
