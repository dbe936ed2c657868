"""Tesora: a retail-banking lakehouse on PySpark.

Sources land incrementally (bronze), are cleansed and screened with an
auditable quarantine (silver), and feed a star schema, marts, KPIs and the
audits that gate publication (gold). Every builder takes DataFrames and
returns DataFrames; only ``tesora.plans.runner`` performs IO.
"""
