"""tenderflow: public-procurement analytics as Spark DataFrame jobs.

Sub-packages:
  sources    - readers: driver tables, triples (N-Triples / parquet), code lists, rates, JSON tenders
  functions  - Column -> Column helpers (IRIs, dates, codes, indicators, string distances)
  operators  - graph patterns, keyed loads, hierarchies, currency, documents, linkage, registry
  plans      - composite jobs: the 20 table builds, the wide lot table and tiers, reports
  streaming  - incremental, checkpointed file-source ingestion
"""

__all__ = ["session"]
