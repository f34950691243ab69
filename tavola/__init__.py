"""tavola — order analytics on Spark DataFrames.

Bronze order lines, their options and a calendar are cleaned into one
sales fact table (``plans.clean``), from which customer value, running
lifetime value, location trends, loyalty and discount metrics are derived
(``plans.metrics``), together with the reports built on them
(``plans.reports``) and exploration queries (``plans.explore``).
"""

__version__ = "0.1.0"
