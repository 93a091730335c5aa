"""Query plans: join strategy and lineage cuts (joins), the end-to-end batch
(medallion), the registered queries (*_queries), their independent SQL
oracle (oracle, oracle_ml) and the physical-plan audit (audit)."""
