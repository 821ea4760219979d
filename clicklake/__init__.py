"""clicklake: a PySpark medallion pipeline for media clickstream events.

Raw drops -> gated bronze tables -> validated, quarantined and sessionized
silver user actions, all as DataFrame -> DataFrame operators.
"""

__version__ = "0.1.0"
