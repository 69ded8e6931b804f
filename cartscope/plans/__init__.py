"""Query plans: the metric library, README insights and the ETL pipeline."""
